"""Text, profile, intake and health queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmloom.functions import contacts as C, names as N, segments as S
from firmloom.functions.constants import (
    BLOCK_SIGNALS,
    DIRECTORY_DOMAINS,
    GENERIC_COMPANY_NAMES,
    GENERIC_NAME_PHRASES,
    GENERIC_NAME_PREFIXES,
    GENERIC_SOCIAL_PATHS,
    NON_LOCATION_WORDS,
    ORG_HINTS,
    PROFILE_PAGE_HINTS,
)
from firmloom.operators import health as HL, intake as IN, profiles as PR
from firmloom.plans import fixtures as fx
from firmloom.plans.fixtures_sql import any_of, first_match
from firmloom.plans.frontier_queries import ts_text
from firmloom.plans.page_queries import clean
from firmloom.plans.registry import query


def in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


# --- scalar text functions ---------------------------------------------------
def _first_seen(source: str, key: str, value: str) -> str:
    """SQL: distinct values per key in order of first appearance, numbered from 1."""
    return f"""SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY n) AS pos, {value} FROM (
        SELECT {key}, {value}, min(n) AS n FROM ({source}) GROUP BY ALL)"""


_MAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"


@query(
    "document_emails",
    f"""WITH c AS (
            SELECT doc_id, list_concat([' Desk.' || doc_id || '@Acme.com. ', 'bad..x@acme.com'], regexp_extract_all(text, '{_MAIL}')) AS l FROM documents
        ), e AS (SELECT doc_id, generate_subscripts(l, 1) AS n, trim(lower({clean('unnest(l)')}), ' .,:;') AS email FROM c)
        """ + _first_seen(
        "SELECT * FROM e WHERE regexp_full_match(email, '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}') AND NOT contains(email, '..')", "doc_id", "email"
    ),
)
def document_emails(spark, sf_dir):
    direct = F.array(F.concat(F.lit(" Desk."), F.col("doc_id").cast("string"), F.lit("@Acme.com. ")), F.lit("bad..x@acme.com"))
    out = fx.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.extract_emails(F.col("text"), direct)).alias("pos", "email"))
    return out.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "email")


_GROUPS = "regexp_extract_all(v, '[0-9]+')"
_DIGITS = f"array_to_string({_GROUPS}, '')"
_VALID_PHONE = rf"""(v IS NOT NULL AND NOT regexp_matches(v, '[A-Za-z.]') AND length({_DIGITS}) BETWEEN 8 AND 15 AND len({_GROUPS}) < 5
    AND length(replace({_DIGITS}, {_DIGITS}[1], '')) > 0 AND NOT regexp_full_match(v, '(?:[0-9]\s+){{4,}}[0-9]')
    AND NOT regexp_matches(v, '\b(?:19|20)[0-9]{{2}}\s*-\s*(?:19|20)[0-9]{{2}}\b')
    AND NOT (len({_GROUPS}) >= 2 AND length({_GROUPS}[1]) = 4 AND length({_GROUPS}[2]) = 4
             AND len(list_filter({_GROUPS}, lambda g: g::BIGINT NOT BETWEEN 1900 AND 2099)) = 0))"""
_FORMAT_PHONE = r"CASE WHEN starts_with(v, '+') OR regexp_matches(v, '[ \-(]') THEN trim(regexp_replace(v, '\s+', ' ', 'g')) ELSE regexp_replace(v, '[^0-9]', '', 'g') END"
_NORMALIZE_PHONE = rf"nullif(trim(regexp_replace({clean('raw')}, '(?i)(?:ext|extension|x)\s*[0-9]+$', ''), ' ,;'), '')"
_ANY_PHONE = r"\+?\d[\d\-\s()]{6,}\d"
_LABELED = (
    r"list_concat(regexp_extract_all({0}, '(?i)(?:phone|tel|telephone|mobile|call us|contact)\s*[:\-]?\s*(\+?\d[\d\-\s()]{{6,}}\d)', 1),"
    r" regexp_extract_all({0}, '(?i)(?:board|switchboard|helpline|hotline)\s*[:\-]?\s*(\+?\d[\d\-\s()]{{6,}}\d)', 1))"
)


@query(
    "document_phones",
    f"""WITH d AS (
            SELECT doc_id, text || ' Phone: 022 4000 ' || lpad((doc_id % 10000)::VARCHAR, 4, '0') AS body,
                   CASE WHEN doc_id % 3 = 0 THEN text ELSE '' END AS block,
                   CASE WHEN doc_id % 7 = 0 THEN ['tel:+91 98765 ' || (10000 + doc_id % 10000) || ' ext 5', 'tel:11111111'] ELSE [] END AS tels FROM documents
        ), p AS (
            SELECT doc_id, unnest(list_concat(list_transform(tels, lambda t: regexp_replace(t, '^tel:', '')), {_LABELED.format('block')}, regexp_extract_all(block, '{_ANY_PHONE}'))) AS raw,
                   generate_subscripts(list_concat(list_transform(tels, lambda t: regexp_replace(t, '^tel:', '')), {_LABELED.format('block')}, regexp_extract_all(block, '{_ANY_PHONE}')), 1) AS n FROM d
        ), pv AS (SELECT doc_id, n, {_NORMALIZE_PHONE} AS v FROM p),
        pk AS (SELECT doc_id, n, {_FORMAT_PHONE} AS phone FROM pv WHERE {_VALID_PHONE}),
        b AS (SELECT doc_id, unnest({_LABELED.format('body')}) AS raw, generate_subscripts({_LABELED.format('body')}, 1) AS n FROM d
              WHERE doc_id NOT IN (SELECT doc_id FROM pk)),
        bv AS (SELECT doc_id, n, {_NORMALIZE_PHONE} AS v FROM b),
        bk AS (SELECT doc_id, n, {_FORMAT_PHONE} AS phone FROM bv WHERE {_VALID_PHONE})
        """ + _first_seen("SELECT * FROM pk UNION ALL SELECT * FROM bk", "doc_id", "phone"),
)
def document_phones(spark, sf_dir):
    d, text = F.col("doc_id"), F.col("text")
    body = F.concat(text, F.lit(" Phone: 022 4000 "), F.lpad((d % 10000).cast("string"), 4, "0"))
    tels = F.when(
        d % 7 == 0,
        F.array(F.concat(F.lit("tel:+91 98765 "), (d % 10000 + 10000).cast("string"), F.lit(" ext 5")), F.lit("tel:11111111")),
    )
    blocks = F.array(F.when(d % 3 == 0, text).otherwise(""))
    out = fx.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(C.extract_phones(body, tels, blocks)).alias("pos", "phone"))
    return out.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "phone")


_PLACE = r"([A-Z][A-Za-z0-9&.,\-\s]{2,80})"
_PLACES = "list_concat(" + ", ".join(
    f"regexp_extract_all(body, '(?i)\\b{lead}{_PLACE}', 1)"
    for lead in (r"headquarters(?:ed)?\s+(?:in|at)\s+", r"based\s+in\s+", r"located\s+in\s+", r"corporate office\s*[:\-]?\s*")
) + ")"
_COMMAS = "(length(v) - length(replace(v, ',', '')))"
_PLAUSIBLE = rf"""(length(v) BETWEEN 6 AND 140 AND NOT regexp_full_match(v, '[0-9\s,.\-]+') AND {_COMMAS} <= 6
    AND NOT ({_COMMAS} = 0 AND length(v) > 50) AND NOT {any_of('lower(v)', NON_LOCATION_WORDS)} AND regexp_matches(v, '[A-Za-z]'))"""


@query(
    "document_locations",
    f"""WITH d AS (
            SELECT doc_id, 'Based in Pune, India. ' || text || ' corporate office: 12 North Road, Mumbai' AS body,
                   ['Area ' || doc_id || ',  West Block', '12345', 'our services'] AS given FROM documents
        ), m AS (SELECT doc_id, unnest(list_concat(given, {_PLACES})) AS raw, generate_subscripts(list_concat(given, {_PLACES}), 1) AS n FROM d),
        v AS (SELECT doc_id, n, {clean('raw')} AS v FROM m), k AS (
            SELECT doc_id, n, v AS place FROM v WHERE {_PLAUSIBLE} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n) <= 10)
        """ + _first_seen("FROM k", "doc_id", "place"),
)
def document_locations(spark, sf_dir):
    body = F.concat(F.lit("Based in Pune, India. "), F.col("text"), F.lit(" corporate office: 12 North Road, Mumbai"))
    given = F.array(
        F.concat(F.lit("Area "), F.col("doc_id").cast("string"), F.lit(",  West Block")), F.lit("12345"), F.lit("our services")
    )
    out = fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(C.extract_location_mentions(body, given)).alias("pos", "place")
    )
    return out.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "place")


_SOCIAL_CASES = [
    "'https://www.linkedin.com/company/c' || c_custkey || '/?x=1'", "'https://linkedin.com/in/jobs'", "'https://linkedin.com/pulse/a' || c_custkey",
    "'https://www.youtube.com/@c' || c_custkey", "'https://youtube.com/watch?v=' || c_custkey", "'https://youtube.com/channel/' || c_custkey",
    "'https://facebook.com/sharer/x'", "'https://facebook.com/Login'", "'https://x.com/c' || c_custkey || '/'", "'https://twitter.com/intent/tweet'",
    "'https://www.tiktok.com/@c' || c_custkey", "'https://acme' || c_custkey || '.com/linkedin.com'", "'https://instagram.com/'",
]


@query(
    "social_profiles",
    f"""WITH l AS (SELECT c_custkey, [{', '.join(_SOCIAL_CASES)}][c_custkey % 13 + 1] AS link FROM customer),
        f AS (SELECT c_custkey, rtrim(split_part(link, '?', 1), '/') AS link FROM l
              WHERE NOT {any_of('lower(link)', ('/share', '/intent/', '/sharer', '/search?', '/hashtag/'))}
                AND {any_of('lower(link)', ('linkedin.com', 'facebook.com', 'instagram.com', 'x.com', 'twitter.com', 'youtube.com', 'tiktok.com'))}),
        s AS (SELECT *, lower(regexp_extract(link, '^[^:]*://([^/?#]*)', 1)) AS dom,
                     list_filter(string_split(regexp_extract(link, '^[^:]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM f)
        SELECT c_custkey, link FROM s WHERE CASE
            WHEN contains(dom, 'linkedin.com') THEN len(seg) >= 2 AND seg[1] IN ('company', 'in', 'school') AND seg[2] NOT IN {in_list(GENERIC_SOCIAL_PATHS)}
            WHEN contains(dom, 'youtube.com') THEN starts_with(seg[1], '@') OR seg[1] IN ('channel', 'c', 'user')
            WHEN {any_of('dom', ('facebook.com', 'instagram.com', 'x.com', 'twitter.com', 'tiktok.com'))} THEN len(seg) >= 1 AND lower(seg[1]) NOT IN {in_list(GENERIC_SOCIAL_PATHS)}
            ELSE false END""",
)
def social_profiles(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    at = lambda a, b="": F.concat(F.lit(a), k, F.lit(b))
    links = F.array(
        at("https://www.linkedin.com/company/c", "/?x=1"), F.lit("https://linkedin.com/in/jobs"), at("https://linkedin.com/pulse/a"),
        at("https://www.youtube.com/@c"), at("https://youtube.com/watch?v="), at("https://youtube.com/channel/"),
        F.lit("https://facebook.com/sharer/x"), F.lit("https://facebook.com/Login"), at("https://x.com/c", "/"),
        F.lit("https://twitter.com/intent/tweet"), at("https://www.tiktok.com/@c"), at("https://acme", ".com/linkedin.com"),
        F.lit("https://instagram.com/"),
    )
    one = F.array(F.get(links, (F.col("c_custkey") % 13).cast("int")))
    return fx.table(spark, sf_dir, "customer").select("c_custkey", F.explode(C.clean_social_profiles(one)).alias("link"))


# --- names -------------------------------------------------------------------
def normalized_name(value: str) -> str:
    step = f"trim({clean(value)}, ' |:-')"
    step = f"trim(regexp_replace({step}, '(?i)\\bOfficial Website\\b', '', 'g'), ' |:-')"
    step = f"trim(regexp_replace({step}, '(?i)\\bHome Page\\b', '', 'g'), ' |:-')"
    return f"nullif(trim(regexp_replace({step}, '(?i) corporate$', ''), ' |:-'), '')"


def strong_name(name: str) -> str:
    prefixes = " OR ".join(f"starts_with(lower({name}), '{p}')" for p in GENERIC_NAME_PREFIXES)
    return f"""coalesce(lower({name}) NOT IN {in_list(GENERIC_COMPANY_NAMES)} AND NOT {any_of(f'lower({name})', GENERIC_NAME_PHRASES)}
        AND NOT (len(string_split({name}, ' ')) >= 4 AND {name} = upper({name})) AND NOT ({prefixes}) AND length({name}) BETWEEN 3 AND 60, false)"""


_NAMED = f"""n AS (SELECT query_id, pos, title, description, company_name, {normalized_name('company_name')} AS name FROM fx_results),
    p AS (SELECT query_id, pos, unnest(string_split_regex({clean('title')}, '\\s+[|\\-–]\\s+|\\|')) AS raw,
                 generate_subscripts(string_split_regex({clean('title')}, '\\s+[|\\-–]\\s+|\\|'), 1) AS i FROM fx_results),
    c AS (SELECT query_id, pos, i, {normalized_name('raw')} AS part FROM p),
    t AS (SELECT query_id, pos, min_by(part, i) FILTER ({strong_name('part')}) AS title_name, count(DISTINCT part) AS parts FROM c GROUP BY ALL)"""


@query(
    "company_name_columns",
    f"""WITH {_NAMED}
        SELECT n.query_id, n.pos, name, {strong_name('name')} AS strong, title_name, coalesce(parts, 0) AS title_parts,
               CASE WHEN length({clean('description')}) >= 40 THEN left({clean('description')}, 400) END AS summary,
               CASE WHEN length({clean('description')}) BETWEEN 30 AND 400 THEN
                    CASE WHEN length({clean('title')}) BETWEEN 30 AND 400 AND length({clean('title')}) < length({clean('description')}) THEN {clean('title')} ELSE {clean('description')} END
                    WHEN length({clean('title')}) BETWEEN 30 AND 400 THEN {clean('title')} END AS best_description
        FROM n LEFT JOIN t ON n.query_id = t.query_id AND n.pos = t.pos""",
    ["fx_results"],
)
def company_name_columns(spark, sf_dir):
    parts = N.title_name_candidates(F.col("title"))
    return fx.results(spark, sf_dir).select(
        "query_id", "pos", N.normalize_company_name(F.col("company_name")).alias("name"),
        N.is_strong_company_name(F.col("company_name")).alias("strong"), N.pick_company_name(parts).alias("title_name"),
        F.size(parts).cast("bigint").alias("title_parts"), N.pick_company_summary(F.col("description")).alias("summary"),
        N.pick_best_description(F.array("description", "title")).alias("best_description"),
    )


# --- profiles ----------------------------------------------------------------
_FINAL = "coalesce(final_url, url)"
_DOMAIN = f"regexp_extract({_FINAL}, '^[^:]*://([^/?#]*)', 1)"


def facts(name_column: str = "company_name", source: str = "fx_results", tag: str = "") -> str:
    return f"""facts{tag}0 AS (
        SELECT *, {_FINAL} AS final, {_DOMAIN} AS domain, NOT {any_of(f'lower({_DOMAIN})', DIRECTORY_DOMAINS)} AS official,
               {first_match(f'lower({_FINAL})', PROFILE_PAGE_HINTS)} AS page_type, {normalized_name(name_column)} AS name,
               CASE WHEN length({clean('description')}) >= 40 THEN left({clean('description')}, 400) END AS summary,
               regexp_extract({_FINAL}, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path
        FROM {source}
    ), facts{tag} AS (
        SELECT *, CASE WHEN official AND {strong_name('name')} THEN
            CASE WHEN path IN ('', '/') THEN 100 ELSE CASE page_type WHEN 'about' THEN 90 WHEN 'contact' THEN 85 WHEN 'leadership' THEN 75 WHEN 'careers' THEN 45 ELSE 60 END END
            + CASE WHEN contains(lower({clean('title')}), lower(name)) THEN 20 ELSE 0 END + CASE WHEN length(name) <= 30 THEN 5 ELSE 0 END
            + CASE WHEN contains(name, '&') OR contains(name, '.') OR contains(name, '-') THEN 3 ELSE 0 END ELSE -1 END AS name_score
        FROM facts{tag}0)"""


_SCALARS = """query_id,
    arg_max(name, name_score::BIGINT * 100000000 - pos) FILTER (name_score >= 0) AS company_name,
    arg_min(summary, pos) FILTER (official AND summary IS NOT NULL) AS company_summary,
    arg_min(final, pos) FILTER (official) AS official_website, arg_min(domain, pos) FILTER (official AND domain <> '') AS primary_domain,
    arg_min(final, pos) FILTER (official AND page_type = 'about') AS about_page,
    arg_min(final, pos) FILTER (official AND page_type = 'contact') AS contact_page,
    arg_min(final, pos) FILTER (official AND page_type = 'careers') AS careers_page,
    arg_min(final, pos) FILTER (official AND page_type = 'leadership') AS leadership_page"""
_LONG = f"""long AS (
    SELECT query_id, pos, 0 AS i, 'source_urls' AS field, final AS value FROM facts
    UNION ALL SELECT query_id, pos, 0, 'all_domains', domain FROM facts WHERE domain <> ''
    UNION ALL SELECT query_id, pos, generate_subscripts(emails, 1) - 1, 'emails', {clean('unnest(emails)')} FROM facts
    UNION ALL SELECT query_id, pos, generate_subscripts(phones, 1) - 1, 'phones', {clean('unnest(phones)')} FROM facts
    UNION ALL SELECT query_id, pos, generate_subscripts(social_profiles, 1) - 1, 'social_profiles', {clean('unnest(social_profiles)')} FROM facts
    UNION ALL SELECT query_id, pos, generate_subscripts(locations, 1) - 1, 'headquarters_or_location_mentions', {clean('unnest(locations)')} FROM facts
)"""


@query(
    "company_name_scores",
    f"WITH {facts()} SELECT query_id, pos, name_score, CASE WHEN name_score >= 0 THEN name END AS name FROM facts",
    ["fx_results"],
)
def company_name_scores(spark, sf_dir):
    return PR.with_page_facts(fx.results(spark, sf_dir)).select("query_id", "pos", "name_score", "name")


@query("profile_scalars", f"WITH {facts()} SELECT {_SCALARS} FROM facts GROUP BY query_id", ["fx_results"])
def profile_scalars(spark, sf_dir):
    return PR.profile_scalars(PR.with_page_facts(fx.results(spark, sf_dir)))


@query(
    "profile_values",
    f"""WITH {facts()}, {_LONG}
        SELECT query_id, field, value, min(pos) AS first_pos, arg_min(i, pos * 1000 + i) AS first_index FROM long
        WHERE value IS NOT NULL GROUP BY query_id, field, value""",
    ["fx_results"],
)
def profile_values(spark, sf_dir):
    return PR.profile_values(PR.with_page_facts(fx.results(spark, sf_dir)))


@query(
    "company_profiles",
    f"""WITH {facts()}, {_LONG}, s AS (SELECT {_SCALARS} FROM facts GROUP BY query_id),
        v AS (SELECT query_id, field, value, min(pos * 1000 + i) AS o FROM long WHERE value IS NOT NULL GROUP BY ALL),
        l AS (SELECT query_id, string_agg(value, ' ; ' ORDER BY o) FILTER (field = 'emails') AS emails,
                     string_agg(value, ' ; ' ORDER BY o) FILTER (field = 'phones') AS phones,
                     string_agg(value, ' ; ' ORDER BY o) FILTER (field = 'source_urls') AS source_urls,
                     string_agg(value, ' ; ' ORDER BY o) FILTER (field = 'headquarters_or_location_mentions') AS locations FROM v GROUP BY query_id)
        SELECT q.query_id, s.company_name, s.official_website, s.contact_page, coalesce(l.emails, '') AS emails, coalesce(l.phones, '') AS phones,
               coalesce(l.source_urls, '') AS source_urls, coalesce(l.locations, '') AS locations
        FROM (SELECT c_custkey AS query_id FROM customer) q LEFT JOIN s USING (query_id) LEFT JOIN l USING (query_id)""",
    ["fx_results"],
)
def company_profiles(spark, sf_dir):
    tasks = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id"))
    out = PR.company_profiles(fx.results(spark, sf_dir), tasks)
    p = F.col("company_profile")
    return out.select(
        "query_id", "company_profile.company_name", "company_profile.official_website",
        p["important_pages"]["contact"].alias("contact_page"),
        *[F.array_join(p[f], " ; ").alias(f) for f in ("emails", "phones", "source_urls")],
        F.array_join(p["headquarters_or_location_mentions"], " ; ").alias("locations"),
    )


@query(
    "query_records",
    """SELECT c.c_custkey AS query_id, c.c_name AS query, 0 AS part, count(r.url) AS result_count,
              coalesce(string_agg(r.url, ' ' ORDER BY r.pos), '') AS urls
       FROM customer c LEFT JOIN fx_results r ON r.query_id = c.c_custkey GROUP BY ALL""",
    ["fx_results"],
)
def query_records(spark, sf_dir):
    tasks = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id"), F.col("c_name").alias("query"))
    items = fx.results(spark, sf_dir).select("query_id", "pos", F.struct("url", "title").alias("item"))
    out = PR.query_records(tasks, items)
    urls = F.array_join(F.transform("results", lambda r: r["url"]), " ")
    return out.select("query_id", "query", "part", F.size("results").cast("bigint").alias("result_count"), urls.alias("urls"))


_REPAIRED = f"""{_NAMED}, rep AS (
    SELECT r.* EXCLUDE (company_name), coalesce(CASE WHEN {strong_name('n.name')} THEN n.name END, t.title_name) AS better, r.company_name AS old_name,
           coalesce(CASE WHEN {strong_name('n.name')} THEN n.name END, t.title_name, r.company_name) AS company_name
    FROM fx_results r JOIN n ON r.query_id = n.query_id AND r.pos = n.pos LEFT JOIN t ON r.query_id = t.query_id AND r.pos = t.pos)"""


@query(
    "repaired_names",
    f"""WITH {_REPAIRED}
        SELECT query_id, pos, company_name, better IS NOT NULL AS repaired,
               array_to_string(string_split({_DOMAIN}, '.')[-2:], '.') AS root_hint FROM rep""",
    ["fx_results"],
)
def repaired_names(spark, sf_dir):
    out = PR.repair_names(fx.results(spark, sf_dir))
    return out.select("query_id", "pos", "company_name", "repaired", F.col("brand_domain_mapping.root_hint").alias("root_hint"))


@query(
    "recomputed_profiles",
    f"""WITH {_REPAIRED}, {facts(source='rep')}, s AS (SELECT {_SCALARS} FROM facts GROUP BY query_id)
        SELECT s.* REPLACE (coalesce(s.company_summary, CASE WHEN query_id % 2 = 0 THEN 'Old summary ' || query_id END) AS company_summary) FROM s""",
    ["fx_results"],
)
def recomputed_profiles(spark, sf_dir):
    old = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("query_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Old summary "), F.col("c_custkey").cast("string"))).alias("company_summary"),
    )
    scalars, _ = PR.recompute_profiles(fx.results(spark, sf_dir), old)
    return scalars


# --- intake ------------------------------------------------------------------
_MATCHING = """SELECT DISTINCT matched_keyword, company_name FROM fx_inputs
    WHERE trim(company_name) <> '' AND (matched_keyword IS NULL OR trim(matched_keyword) = '' OR lower(company_name) LIKE '%' || lower(matched_keyword) || '%')"""


def segment(value: str) -> str:
    step = f"trim(regexp_replace({value}, '\\s+', ' ', 'g'), ' ,;:-')"
    step = f"regexp_replace({step}, '(?i)^(?:m/s|m\\.s\\.)\\s+', '')"
    return f"trim(regexp_replace({step}, '(?i)\\([^)]*booking[^)]*\\)', '', 'g'), ' ,;:-')"


@query("matching_inputs", _MATCHING, ["fx_inputs"])
def matching_inputs(spark, sf_dir):
    return IN.matching_inputs(fx.inputs(spark, sf_dir))


@query("limited_inputs", f"SELECT * FROM ({_MATCHING}) ORDER BY company_name, matched_keyword NULLS FIRST LIMIT 25", ["fx_inputs"])
def limited_inputs(spark, sf_dir):
    return IN.matching_inputs(fx.inputs(spark, sf_dir), limit=25)


_MARK = "(?:^|\\s)[0-9]+\\)\\s*"
_NUMBERED = f"""(CASE WHEN len(regexp_extract_all(company_name, '{_MARK}')) >= 2
    THEN list_filter(list_transform(string_split_regex(company_name, '{_MARK}')[2:], lambda x: {segment('x')}), lambda x: x <> '') ELSE [company_name] END)"""
_SEGMENTS = f"list_filter(list_transform(flatten(list_transform({_NUMBERED}, lambda y: string_split_regex(y, '[,\\n;]+'))), lambda z: {segment('z')}), lambda z: z <> '')"


def segment_score(s: str) -> str:
    return f"""(CASE WHEN matched_keyword <> '' AND contains(lower({s}), lower(matched_keyword)) THEN 100 ELSE 0 END
        + CASE WHEN {any_of(f'lower({s})', ORG_HINTS)} THEN 25 ELSE 0 END + CASE WHEN contains(lower({s}), 'limited') THEN 15 ELSE 0 END
        - CASE WHEN len(string_split({s}, ' ')) <= 1 THEN 10 ELSE 0 END - CASE WHEN contains({s}, '.') AND NOT contains({s}, ' ') THEN 90 ELSE 0 END
        - CASE WHEN regexp_full_match({s}, '[A-Z][a-z]+(?:\\s+[A-Z][a-z]+){{1,3}}') THEN 20 ELSE 0 END)"""


_PIECES = f"""m AS ({_MATCHING}), g AS (
    SELECT matched_keyword, company_name, unnest({_SEGMENTS}) AS segment, generate_subscripts({_SEGMENTS}, 1) AS pos FROM m)"""


@query(
    "company_segments",
    f"WITH {_PIECES} SELECT matched_keyword, company_name, pos, segment, {segment_score('segment')} AS score FROM g",
    ["fx_inputs"],
)
def company_segments(spark, sf_dir):
    rows = IN.matching_inputs(fx.inputs(spark, sf_dir))
    out = rows.select("*", F.posexplode(S.split_candidate_segments(F.col("company_name"))).alias("pos", "segment"))
    return out.select(
        "matched_keyword", "company_name", (F.col("pos") + 1).cast("bigint").alias("pos"), "segment",
        S.score_segment(F.col("segment"), F.col("matched_keyword")).alias("score"),
    )


@query(
    "search_inputs",
    f"""WITH {_PIECES}, b AS (
            SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY matched_keyword, company_name ORDER BY {segment_score('segment')} DESC, length(segment) DESC, pos) = 1
        ), d AS (SELECT *, {segment('segment')} AS search FROM b QUALIFY row_number() OVER (PARTITION BY {segment('segment')} ORDER BY company_name, matched_keyword NULLS FIRST) = 1)
        SELECT CASE WHEN matched_keyword <> '' THEN {segment('matched_keyword')} END AS matched_keyword, {segment('company_name')} AS raw_company_name,
               search AS search_company_name FROM d
        WHERE search NOT IN (SELECT s_name || ' ' || n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 = 0)""",
    ["fx_inputs"],
)
def search_inputs(spark, sf_dir):
    done = (
        fx.table(spark, sf_dir, "supplier")
        .join(F.broadcast(fx.table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
        .where(F.col("s_suppkey") % 5 == 0)
        .select(F.concat(F.lit(" M/s "), "s_name", F.lit("  "), "n_name", F.lit(",")).alias("company_name"))
    )
    return IN.search_inputs(fx.inputs(spark, sf_dir), done).drop("source_name")


@query(
    "alternating_engines",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN 'duckduckgo' ELSE 'google' END AS primary_engine,
              CASE WHEN c_custkey % 2 = 1 THEN 'google' ELSE 'duckduckgo' END AS fallback_engine FROM customer""",
)
def alternating_engines(spark, sf_dir):
    pair = S.assign_alternating(F.col("c_custkey"), "google", "duckduckgo")
    return fx.table(spark, sf_dir, "customer").select(
        "c_custkey", pair["primary"].alias("primary_engine"), pair["fallback"].alias("fallback_engine")
    )


# --- health ------------------------------------------------------------------
@query(
    "query_status",
    f"""WITH t AS (SELECT c_custkey AS query_id, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status,
                   CASE c_custkey % 11 WHEN 0 THEN 'HTTP 403 Forbidden' WHEN 1 THEN 'timeout' END AS error, CASE WHEN c_custkey % 6 = 0 THEN 'fallback used' END AS note FROM customer),
        r AS (SELECT query_id, CASE WHEN seq % 211 = 0 THEN 'Access Denied' ELSE title END AS title, {_FINAL} AS final FROM fx_results),
        f AS (SELECT query_id, count(*) AS n, bool_or({any_of("lower(coalesce(title, '') || ' ' || final)", BLOCK_SIGNALS)}) AS hit FROM r GROUP BY query_id),
        j AS (SELECT t.*, coalesce(status, 'failed') AS given, nullif(concat_ws(' | ', error, note), '') AS details, coalesce(n, 0) AS n, coalesce(hit, false) AS hit FROM t LEFT JOIN f USING (query_id)),
        k AS (SELECT *, hit OR coalesce({any_of('lower(details)', BLOCK_SIGNALS)}, false) AS blocked FROM j)
        SELECT query_id, CASE WHEN blocked THEN 'blocked' WHEN given = 'ok' AND n = 0 THEN 'failed' ELSE given END AS inferred_status,
               CASE WHEN blocked THEN coalesce(details, 'Detected blocking or challenge indicators in search/fetch results.')
                    WHEN given = 'ok' AND n = 0 THEN coalesce(details, 'Search completed but produced no result URLs.') ELSE details END AS status_detail FROM k""",
    ["fx_results"],
)
def query_status(spark, sf_dir):
    k = F.col("c_custkey")
    tasks = fx.table(spark, sf_dir, "customer").select(
        k.alias("query_id"), F.when(k % 9 == 0, F.lit(None)).when(k % 4 == 0, "failed").otherwise("ok").alias("status"),
        F.when(k % 11 == 0, "HTTP 403 Forbidden").when(k % 11 == 1, "timeout").alias("error"),
        F.when(k % 6 == 0, "fallback used").alias("note"),
    )
    results = fx.results(spark, sf_dir).withColumn("title", F.when(F.col("seq") % 211 == 0, "Access Denied").otherwise(F.col("title")))
    return HL.infer_query_status(tasks, results).select("query_id", "inferred_status", "status_detail")


_JOINT_TITLE = "CASE WHEN seq % 3 = 0 THEN 'In the news' WHEN seq % 50 = 1 THEN 'denied' ELSE title END"
_JOINT_FINAL = f"CASE WHEN seq % 37 = 0 THEN {_FINAL} || '/sign' WHEN seq % 41 = 0 THEN 'you are' ELSE {_FINAL} END"


@query(
    "joined_query_status",
    f"""WITH t AS (SELECT c_custkey AS query_id, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status,
                   CASE c_custkey % 11 WHEN 0 THEN 'HTTP 403 Forbidden' WHEN 1 THEN 'timeout' WHEN 2 THEN 'no access' END AS error, CASE WHEN c_custkey % 6 = 0 THEN 'fallback used' END AS note FROM customer),
        r AS (SELECT query_id, seq, lower(coalesce({_JOINT_TITLE}, '') || ' ' || {_JOINT_FINAL}) AS item FROM fx_results),
        g AS (SELECT query_id, count(*) AS n, string_agg(item, ' ' ORDER BY seq) AS items FROM r GROUP BY query_id),
        j AS (SELECT t.*, coalesce(status, 'failed') AS given, nullif(concat_ws(' | ', error, note), '') AS details, coalesce(n, 0) AS n, items FROM t LEFT JOIN g USING (query_id)),
        k AS (SELECT *, coalesce({any_of("concat_ws(' ', lower(details), items)", BLOCK_SIGNALS)}, false) AS blocked FROM j)
        SELECT query_id, CASE WHEN blocked THEN 'blocked' WHEN given = 'ok' AND n = 0 THEN 'failed' ELSE given END AS inferred_status,
               CASE WHEN blocked THEN coalesce(details, 'Detected blocking or challenge indicators in search/fetch results.')
                    WHEN given = 'ok' AND n = 0 THEN coalesce(details, 'Search completed but produced no result URLs.') ELSE details END AS status_detail FROM k""",
    ["fx_results"],
)
def joined_query_status(spark, sf_dir):
    k, seq = F.col("c_custkey"), F.col("seq")
    tasks = fx.table(spark, sf_dir, "customer").select(
        k.alias("query_id"), F.when(k % 9 == 0, F.lit(None)).when(k % 4 == 0, "failed").otherwise("ok").alias("status"),
        F.when(k % 11 == 0, "HTTP 403 Forbidden").when(k % 11 == 1, "timeout").when(k % 11 == 2, "no access").alias("error"),
        F.when(k % 6 == 0, "fallback used").alias("note"),
    )
    final = F.coalesce("final_url", "url")
    results = fx.results(spark, sf_dir).select(
        "query_id", "seq", "url", F.when(seq % 3 == 0, "In the news").when(seq % 50 == 1, "denied").otherwise(F.col("title")).alias("title"),
        F.when(seq % 37 == 0, F.concat(final, F.lit("/sign"))).when(seq % 41 == 0, "you are").otherwise(final).alias("final_url"),
    )
    return HL.infer_joined_status(tasks, results).select("query_id", "inferred_status", "status_detail")


@query(
    "block_guard",
    """WITH r AS (SELECT *, sum(blocked::INT) OVER (PARTITION BY run_id ORDER BY idx)::BIGINT AS blocked_so_far FROM fx_fetches),
       s AS (SELECT run_id, min(idx) AS stop_idx FROM r WHERE idx >= 30 AND blocked_so_far / idx >= 0.08 GROUP BY run_id)
       SELECT run_id, idx, event_id, blocked_so_far, stop_idx FROM r LEFT JOIN s USING (run_id) WHERE stop_idx IS NULL OR idx <= stop_idx""",
    ["fx_fetches"],
)
def block_guard(spark, sf_dir):
    out = HL.block_guard(fx.fetches(spark, sf_dir), min_processed=30, stop_rate=0.08)
    return out.select("run_id", "idx", "event_id", "blocked_so_far", "stop_idx")


@query(
    "checkpoint_metrics",
    """SELECT count(*) AS completed_count, count_if(status = 'ok') AS succeeded_count, count_if(status <> 'ok') AS failed_count,
              1000000 AS total_count, 1000000 - count(*) AS pending_count, max(event_id) AS last_id, arg_max(status, event_id) AS last_status FROM fx_fetches""",
    ["fx_fetches"],
)
def checkpoint_metrics(spark, sf_dir):
    rows = fx.fetches(spark, sf_dir).withColumn("id", F.col("event_id"))
    return HL.outcome_counters(rows, total=1_000_000, order="event_id")


@query(
    "run_counters",
    """SELECT run_id, count(*) AS completed_count, count_if(status = 'ok') AS succeeded_count, count_if(status <> 'ok') AS failed_count,
              arg_max(event_id, idx) AS last_id, arg_max(status, idx) AS last_status FROM fx_fetches GROUP BY run_id""",
    ["fx_fetches"],
)
def run_counters(spark, sf_dir):
    return HL.outcome_counters(fx.fetches(spark, sf_dir).withColumn("id", F.col("event_id")), by="run_id")


_ROLLUP = """t AS (
    SELECT host, avg((status = 'ok')::INT) AS success_rate, avg(blocked::INT) AS challenge_rate, avg(latency_ms) AS avg_latency_ms,
           max(fetched_at) FILTER (blocked) AS last_blocked_at FROM fx_fetches GROUP BY host
), l AS (SELECT host, blocked FROM fx_fetches QUALIFY row_number() OVER (PARTITION BY host ORDER BY fetched_at DESC, event_id DESC) <= 20),
b AS (SELECT host, avg(blocked::INT) AS ban_score FROM l GROUP BY host)"""


@query(
    "host_rollup",
    f"""WITH {_ROLLUP} SELECT host, round(success_rate, 6) AS success_rate, round(challenge_rate, 6) AS challenge_rate, round(avg_latency_ms, 6) AS avg_latency_ms,
               strftime(last_blocked_at, '%Y-%m-%d %H:%M:%S') AS last_blocked_at, round(ban_score, 6) AS ban_score,
               CASE WHEN challenge_rate >= 0.2 OR ban_score >= 0.5 THEN 'browser' ELSE 'http' END AS preferred_render_mode FROM t JOIN b USING (host)""",
    ["fx_fetches"],
)
def host_rollup(spark, sf_dir):
    out = HL.with_preferred_mode(HL.host_rollup(fx.fetches(spark, sf_dir)))
    rounded = [F.round(c, 6).alias(c) for c in ("success_rate", "challenge_rate", "avg_latency_ms", "ban_score")]
    return out.select("host", *rounded, ts_text("last_blocked_at"), "preferred_render_mode")


@query(
    "latest_fetches",
    """SELECT url_hash, event_id, status, latency_ms FROM fx_fetches
       QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY fetched_at DESC, event_id DESC) = 1""",
    ["fx_fetches"],
)
def latest_fetches(spark, sf_dir):
    return HL.latest_fetches(fx.fetches(spark, sf_dir)).select("url_hash", "event_id", "status", "latency_ms")
