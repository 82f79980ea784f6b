"""The derived inputs of ``fixtures`` again, as common table expressions in plain SQL."""

from __future__ import annotations

from firmloom.functions.constants import (
    BROWSER_HINTS,
    HIGH_VALUE_HINTS,
    IMPORTANT_SOURCE_TYPES,
    LOW_VALUE_HINTS,
    STARTER_TRACKING_PARAMS,
    TRACKING_PARAMS,
)

NOW = "TIMESTAMP '2024-01-15 00:00:00'"


def any_of(value: str, words) -> str:
    return "(" + " OR ".join(f"contains({value}, '{w}')" for w in words) + ")"


def pick(value: str, choices) -> str:
    """CASE on ``value % len(choices)``; choices are SQL expressions."""
    arms = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices))
    return f"(CASE {value} % {len(choices)} {arms} END)"


def first_match(value: str, rules, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {any_of(value, words)} THEN '{name}'" for name, words in rules.items())
    return f"(CASE {arms} ELSE {default} END)"


def canonical_url(u: str, tracking=TRACKING_PARAMS) -> str:
    """SQL for the canonical URL of an absolute http(s) URL."""
    scheme = f"lower(split_part(trim({u}), '://', 1))"
    authority = f"lower(regexp_extract(trim({u}), '^[^:]*://([^/?#]*)', 1))"
    path = f"regexp_extract(trim({u}), '^[^:]*://[^/?#]*([^?#]*)', 1)"
    path = f"(CASE WHEN {path} IN ('', '/') THEN '/' ELSE rtrim({path}, '/') END)"
    query = f"regexp_extract(trim({u}), '^[^?#]*\\?([^#]*)', 1)"
    names = ", ".join(f"'{t}'" for t in tracking)
    dec = lambda x: f"url_decode(replace({x}, '+', ' '))"
    enc = lambda x: f"replace(url_encode({x}), '%20', '+')"
    fields = f"list_filter(string_split({query}, '&'), lambda f: contains(f, '=') AND NOT regexp_matches(f, '^[^=]*=$'))"
    pairs = f"list_transform({fields}, lambda f: {{'k': {dec('split_part(f, chr(61), 1)')}, 'v': {dec('substr(f, instr(f, chr(61)) + 1)')}}})"
    kept = f"list_sort(list_filter({pairs}, lambda p: lower(p.k) NOT IN ({names})))"
    text = f"array_to_string(list_transform({kept}, lambda p: {enc('p.k')} || '=' || {enc('p.v')}), '&')"
    return f"({scheme} || '://' || {authority} || {path} || CASE WHEN {text} = '' THEN '' ELSE '?' || {text} END)"


def url_parts(c: str) -> dict[str, str]:
    """SQL for the columns derived from a canonical URL."""
    host = f"regexp_extract({c}, '^[^:]*://([^/?#]*)', 1)"
    labels = f"list_filter(string_split({host}, '.'), lambda x: x <> '')"
    return {
        "url_hash": f"sha256(regexp_replace({c}, '^([^:]+://[^/?#]*)(\\?|$)', '\\1/\\2'))",
        "scheme": f"split_part({c}, '://', 1)",
        "host": host,
        "etld1": f"CASE WHEN len({labels}) < 2 THEN {host} ELSE array_to_string({labels}[-2:], '.') END",
        "path": f"coalesce(nullif(regexp_extract({c}, '^[^:]*://[^/?#]*([^?#]*)', 1), ''), '/')",
        "query_norm": f"CASE WHEN contains({c}, '?') THEN split_part({c}, '?', 2) ELSE '' END",
    }


def score(url: str, depth: str, source: str) -> str:
    return (
        f"greatest(100.0::DOUBLE + CASE WHEN {source} = 'manual_seed' THEN 40 ELSE 0 END"
        f" + CASE WHEN {any_of(f'lower({url})', HIGH_VALUE_HINTS)} THEN 35 ELSE 0 END"
        f" - CASE WHEN {any_of(f'lower({url})', LOW_VALUE_HINTS)} THEN 30 ELSE 0 END"
        f" - least({depth} * 5, 40), 5.0::DOUBLE)"
    )


def source_type(url: str, source: str) -> str:
    hinted = first_match(f"lower({url})", IMPORTANT_SOURCE_TYPES, "'discovered_link'")
    return f"CASE WHEN {source} = 'discovered_link' THEN {hinted} ELSE {source} END"


def render_mode(url: str) -> str:
    return f"CASE WHEN {any_of(f'lower({url})', BROWSER_HINTS)} THEN 'browser' ELSE 'http' END"


_P = url_parts("canonical_url")

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


cte("fx_seeds", """
    WITH base AS (
        SELECT page_id, regexp_extract(url, '^[^?#]*') AS head, url FROM pages
    ), suffixed AS (
        SELECT page_id, head || ['/about', '/contact-us', '/team', '/login', '/terms', ''][page_id % 6 + 1]
               || substr(url, length(head) + 1) AS u
        FROM base
    ), spelled AS (
        SELECT page_id, 0 AS n, u AS url FROM suffixed
        UNION ALL
        SELECT page_id, 1, CASE WHEN contains(u, '?') AND NOT contains(u, '#') THEN u || '&utm_medium=x'
                                ELSE upper(split_part(u, '://', 1)) || '://' || split_part(u, '://', 2) END
        FROM suffixed
    )
    SELECT url, CASE WHEN page_id % 4 = 0 THEN 'manual_seed' ELSE 'discovered_link' END AS source_type,
           page_id % 10 AS depth, page_id * 2 + n + 1 AS id
    FROM spelled""")

cte("fx_canon", f"SELECT *, {canonical_url('url')} AS canonical_url FROM fx_seeds", "fx_seeds")
cte("fx_canon_starter", f"SELECT *, {canonical_url('url', STARTER_TRACKING_PARAMS)} AS canonical_url FROM fx_seeds", "fx_seeds")

cte("fx_frontier", f"""
    WITH typed AS (
        SELECT id, canonical_url, depth, {source_type('canonical_url', 'source_type')} AS source_type,
               {_P['url_hash']} AS url_hash, {_P['host']} AS host, {_P['etld1']} AS etld1, {_P['path']} AS path,
               {_P['query_norm']} AS query_norm, {render_mode('canonical_url')} AS render_mode
        FROM fx_canon
        QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY id) = 1
    )
    SELECT *, {score('canonical_url', 'depth', 'source_type')} AS priority,
           CASE id % 5 WHEN 0 THEN 'fetched' WHEN 1 THEN 'leased' ELSE 'ready' END AS state,
           CASE id % 3 WHEN 1 THEN TIMESTAMP '2024-01-14 00:00:00' WHEN 2 THEN TIMESTAMP '2024-01-16 00:00:00' END AS next_fetch_at,
           id % 4 AS retry_count,
           CASE WHEN id % 5 = 1 AND id % 2 = 0 THEN TIMESTAMP '2024-01-14 23:00:00'
                WHEN id % 5 = 1 THEN TIMESTAMP '2024-01-15 01:00:00' END AS leased_until,
           CASE WHEN id % 5 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS last_fetched_at,
           CASE WHEN id % 5 = 0 THEN 200 END AS http_status
    FROM typed""", "fx_canon")

cte("fx_domain_state", f"""
    WITH hosts AS (
        SELECT DISTINCT regexp_extract({canonical_url('url')}, '^[^:]*://([^/?#]*)', 1) AS host FROM pages
    )
    SELECT host, length(host) * 10 + 500 AS crawl_delay_ms, length(host) % 3 + 1 AS max_parallelism,
           CASE WHEN length(host) % 11 = 0 THEN 'browser' ELSE 'http' END AS preferred_render_mode,
           (length(host) % 10) / 20.0 AS challenge_rate,
           CASE WHEN length(host) % 13 = 0 THEN 0.6 ELSE 0.1 END AS ban_score,
           (length(host) % 5 + 1) * 24 AS recrawl_interval_hours
    FROM hosts WHERE length(host) % 4 <> 0""")

cte("fx_fetches", """
    SELECT event_id, 'https://h' || user_id || '.example.com/p' || event_id % 50 AS url,
           sha256('https://h' || user_id || '.example.com/p' || event_id % 50) AS url_hash,
           'h' || user_id || '.example.com' AS host, ts AS fetched_at, user_id % 10 AS run_id,
           CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status_code,
           CAST(floor(value) AS INT) AS latency_ms, event_type = 'error' AND event_id % 3 = 0 AS blocked,
           CASE WHEN event_type = 'error' THEN 'http 503' END AS block_reason,
           CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'Access denied' ELSE 'Page ' || event_id END AS title,
           row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS idx
    FROM events""")

cte("fx_company_html", """
    WITH s AS (
        SELECT s_suppkey AS k, s_name AS name, n_name AS nation, 'https://www.s' || s_suppkey || '.example.com' AS site,
               lpad(s_suppkey::VARCHAR, 4, '0') AS digits
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    ), n AS (
        SELECT *, '<script type="application/ld+json">{"@type":"' || ['Organization', 'LocalBusiness', 'WebSite', 'None'][k % 4 + 1]
            || '","name":"' || name || ' Ltd","url":"' || site || '/",'
            || CASE WHEN k % 3 = 0 THEN '"telephone":"+1 555 000 ' || digits || '",' ELSE '' END
            || '"address":{"streetAddress":"' || k || ' Main Street","addressLocality":"' || nation
            || '","postalCode":"1' || digits || '"},"sameAs":["https://x.com/s' || k
            || '"],"industry":"Freight","description":"' || name || '  carries freight"}</script>' AS node
        FROM s
    )
    SELECT k AS page_id, site || ['/', '/about-us', '/contact', '/leadership', '/careers'][k % 5 + 1] AS url,
           '<html><head><title>' || name || ' | Home</title><meta name="description" content="' || name || ' of ' || nation
           || ' moves  goods.">' || CASE WHEN k % 4 < 3 THEN node ELSE '' END
           || '</head><body><nav><a href="/about-us">About</a><a href="/contact">Contact</a>'
           || '<a href="/leadership">Team</a><a href="/careers">Jobs</a><a href="/products">Products</a></nav>'
           || '<a href="mailto:info@s' || k || '.example.com?subject=hi">mail</a><a href="tel:+91 22 4000 '
           || digits || '">call</a><a href="https://www.linkedin.com/company/s' || k
           || '/?trk=1">in</a><p>' || k || ' Long Acre Road, ' || nation
           || '</p><p>sales@s' || k || '.example.com</p><!-- <a href="/hidden">x</a> --></body></html>' AS html,
           k, name, nation, site, digits
    FROM n""")

cte("fx_observations", """
    SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'Company ' || (o_custkey + CASE WHEN o_orderkey % 40 = 1 THEN 1 ELSE 0 END) END AS company_name,
        CASE WHEN o_orderkey % 7 <> 0 THEN 'https://c' || o_custkey || '.example.com/' END AS website,
        CASE WHEN o_orderkey % 7 <> 0 THEN 'c' || o_custkey || '.example.com' END AS primary_domain,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE 'e' || o_orderkey % 17 || '@x.com' END AS email,
        CASE WHEN o_orderkey % 4 <> 0 THEN '+91 22 ' || (o_orderkey % 1000 + 10000000) END AS phone,
        CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 90 || ' Main Road' END AS address,
        CASE WHEN o_orderkey % 9 <> 0 THEN 'City ' || o_orderkey % 13 END AS city,
        CASE WHEN o_orderkey % 10 <> 0 THEN 'State ' || o_orderkey % 8 END AS state_region,
        CASE WHEN o_orderkey % 13 <> 0 THEN 'Country ' || o_orderkey % 4 END AS country,
        CASE WHEN o_orderkey % 14 <> 0 THEN (o_orderkey % 9999)::VARCHAR END AS postal_code,
        CASE WHEN o_orderkey % 2 <> 0 THEN 'Industry ' || o_orderkey % 5 END AS industry,
        CASE WHEN o_orderkey % 8 <> 0 THEN 'Text ' || o_orderkey END AS description,
        ['https://x.com/c' || o_custkey, CASE WHEN o_orderkey % 4 = 1 THEN '' ELSE 'https://in.com/' || o_orderkey % 3 END] AS social_links,
        'https://src' || o_orderkey % 100 || '.example.com/p' || o_orderkey // 2 AS source_url,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'contact' WHEN '2-HIGH' THEN 'about' WHEN '3-MEDIUM' THEN 'leadership'
             WHEN '4-NOT SPECIFIED' THEN 'careers' WHEN '5-LOW' THEN 'generic' END AS page_type,
        CASE o_orderstatus WHEN 'P' THEN 0.68::DOUBLE WHEN 'F' THEN 0.50::DOUBLE ELSE 0.92::DOUBLE END AS confidence,
        'heuristic-v1' AS extractor_version, o_orderdate AS observed_at
    FROM orders""")

_Q = "(o_custkey % 500)"
cte("fx_results", f"""
    WITH r AS (
        SELECT {_Q} AS query_id, o_orderkey AS o,
               'https://' || {pick('o_orderkey', [f"'www.acme' || {_Q} || '.com'", f"'acme' || {_Q} || '.in'", "'www.linkedin.com'", "'en.wikipedia.org'", f"'acme' || {_Q} || '.com'", "'www.justdial.com'"])}
               || {pick('o_orderkey', ["'/'", "'/about'", "'/contact'", "'/leadership'", "'/careers'", "'/x'", "''"])} AS url,
               {pick('o_orderkey', [f"'Acme ' || {_Q} || ' Logistics | Home'", "'CONTACT US NOW PLEASE'", "'Our Team'", f"'Acme ' || {_Q} || ' - Official Website'", 'NULL'])} AS title,
               {pick('o_orderkey', [f"'Acme ' || {_Q} || '  moves goods and people across the whole country every day.'", "'Too short'", 'NULL', f"'  Since 1950 Acme ' || {_Q} || ' has run   warehouses, trucks and trains for everyone. '"])} AS description,
               {pick('o_orderkey', [f"'Acme ' || {_Q} || ' Logistics'", "'Contact Us'", 'NULL', "'Welcome to Acme'", f"'A&B ' || {_Q} || ' Movers'", f"'Acme ' || {_Q} || ' corporate'", "'  '", "'Leadership'"])} AS company_name
        FROM orders
    )
    SELECT query_id, o AS seq, row_number() OVER (PARTITION BY query_id ORDER BY o) AS pos, url,
           CASE WHEN o % 13 <> 0 THEN url END AS final_url, title, description, company_name,
           CASE WHEN o % 3 = 0 THEN []::VARCHAR[] ELSE ['info' || query_id || '@acme.com', 'sales' || o % 4 || '@acme.com'] END AS emails,
           ['+91 22 4000 ' || lpad((o % 9)::VARCHAR, 4, '0')] AS phones,
           ['https://www.linkedin.com/company/acme' || query_id, 'https://x.com/a' || o % 3] AS social_profiles,
           CASE WHEN o % 4 = 0 THEN []::VARCHAR[] ELSE ['Pune, Area  ' || o % 6] END AS locations
    FROM r""")

cte("fx_inputs", """
    WITH r AS (
        SELECT CASE (s_suppkey // 3) % 3 WHEN 0 THEN n_name WHEN 1 THEN ' ' END AS matched_keyword,
               CASE s_suppkey % 3
                   WHEN 0 THEN '1) M/s ' || s_name || ' Private Limited 2) ' || n_name || ' Logistics (online booking), ' || n_name || '.com'
                   WHEN 1 THEN n_name || ' Travels, ' || s_name || '; ' || n_name || ' Roadways Pvt Ltd'
                   ELSE s_name || ' ' || n_name END AS company_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    )
    SELECT * FROM r UNION ALL SELECT * FROM r""")


def with_ctes(names, body: str) -> str:
    """``body`` preceded by the named expressions and everything they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for other in needs:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = ", ".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered)
    body = body.strip()
    if not parts:
        return body
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(opening):
            return f"{opening}{parts}, {body[len(opening):]}"
    return f"WITH {parts} {body}"
