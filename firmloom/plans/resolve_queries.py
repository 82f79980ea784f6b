"""Entity-resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmloom.functions.constants import PAGE_TYPE_WEIGHTS
from firmloom.operators import pages as PG, resolve as R, survivorship as SV
from firmloom.plans import fixtures as fx
from firmloom.plans.fixtures_sql import canonical_url, url_parts
from firmloom.plans.frontier_queries import ts_text
from firmloom.plans.page_queries import both
from firmloom.plans.registry import query

_WEIGHT = "confidence * CASE page_type " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in PAGE_TYPE_WEIGHTS.items()) + " ELSE 0.35::DOUBLE END"
_PREPARED = f"""prep AS (
    SELECT *, {_WEIGHT} AS weight, coalesce(nullif(company_name, ''), nullif(website, ''), source_url) AS fallback FROM fx_observations)"""


def prepared(spark, sf_dir):
    return SV.with_resolution_columns(fx.observations(spark, sf_dir))


@query(
    "observation_rows",
    f"""WITH b AS (SELECT page_id, url FROM pages UNION ALL SELECT 1000000 + page_id, url FROM fx_company_html),
        c AS (SELECT page_id, url AS source_url, {canonical_url('url')} AS canonical_url FROM b)
        SELECT page_id, source_url, {url_parts('canonical_url')['url_hash']} AS url_hash, page_id || '.json' AS evidence_object_key FROM c""",
    ["fx_company_html"],
)
def observation_rows(spark, sf_dir):
    parsed = PG.parse_pages(both(spark, sf_dir))
    key = F.concat(F.col("page_id").cast("string"), F.lit(".json"))
    return R.observation_rows(parsed, "url", key).select("page_id", "source_url", "url_hash", "evidence_object_key")


@query(
    "lookup_companies",
    """WITH c AS (
            SELECT c_custkey + 1 AS id, CASE WHEN c_custkey % 3 <> 0 THEN 'c' || (c_custkey * 7 % 900) || '.example.com' END AS primary_domain,
                   'Company ' || c_custkey % 700 AS canonical_name FROM customer)
       SELECT o.id, (SELECT min(c.id) FROM c WHERE c.primary_domain = o.primary_domain OR c.canonical_name = o.company_name) AS matched_company_id
       FROM fx_observations o""",
    ["fx_observations"],
)
def lookup_companies(spark, sf_dir):
    k = F.col("c_custkey")
    companies = fx.table(spark, sf_dir, "customer").select(
        (k + 1).alias("id"),
        F.when(k % 3 != 0, F.concat(F.lit("c"), (k * 7 % 900).cast("string"), F.lit(".example.com"))).alias("primary_domain"),
        F.concat(F.lit("Company "), (k % 700).cast("string")).alias("canonical_name"),
    )
    return R.lookup_companies(prepared(spark, sf_dir), companies).select("id", "matched_company_id")


@query("weighted_confidence", f"WITH {_PREPARED} SELECT id, round(weight, 6) AS weight, fallback AS fallback_name FROM prep", ["fx_observations"])
def weighted_confidence(spark, sf_dir):
    return prepared(spark, sf_dir).select("id", F.round("weight", 6).alias("weight"), "fallback_name")


def _survivor(field: str, out: str) -> str:
    filled = f"{field} IS NOT NULL AND {field} <> ''"
    return f"coalesce(arg_max({field}, id) FILTER ({filled} AND (earlier_{field} = 0 OR weight > before)), arg_min({field}, id) FILTER (n = 1 AND {field} IS NOT NULL)) AS {out}"


_ORDERED = "ordered AS (SELECT *, row_number() OVER w AS n, lag(weight) OVER w AS before, " + ", ".join(
    f"coalesce(count(*) FILTER ({f} IS NOT NULL AND {f} <> '') OVER (PARTITION BY company_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier_{f}"
    for f in SV.FIELDS
) + " FROM rows WINDOW w AS (PARTITION BY company_id ORDER BY id))"
_MERGED = ", ".join(_survivor(f, out) for f, out in SV.FIELDS.items())
_COMPANY = f"""company_id, {_MERGED},
    coalesce(arg_max(company_name, id) FILTER (company_name <> '' AND weight > before), arg_min(fallback, id)) AS canonical_name,
    arg_max(primary_domain, id) FILTER (primary_domain IS NOT NULL) AS primary_domain,
    round(max(CASE WHEN n = 1 THEN confidence ELSE weight END), 6) AS confidence,
    strftime(min(observed_at), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') AS last_seen_at,
    round(arg_max(weight, id), 6) AS last_weight, arg_max(page_type, id) AS last_page_type"""


def company_columns(merged):
    return merged.select(
        "company_id", *SV.FIELDS.values(), "canonical_name", "primary_domain", F.round("confidence", 6).alias("confidence"),
        ts_text("first_seen_at"), ts_text("last_seen_at"),
        F.round("confidence_details.weighted_confidence", 6).alias("last_weight"),
        F.col("confidence_details.page_type").alias("last_page_type"),
    )


def _grouped(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    return rows.withColumn("company_id", F.coalesce(F.regexp_extract("primary_domain", "[0-9]+", 0), F.lit("0")).cast("bigint") % 400)


_ROWS = f"{_PREPARED}, rows AS (SELECT *, coalesce(regexp_extract(primary_domain, '[0-9]+'), '0')::BIGINT % 400 AS company_id FROM prep)"


@query("survivorship", f"WITH {_ROWS}, {_ORDERED} SELECT {_COMPANY} FROM ordered GROUP BY company_id", ["fx_observations"])
def survivorship(spark, sf_dir):
    return company_columns(SV.merged_companies(_grouped(spark, sf_dir)))


@query(
    "survivorship_starter",
    f"""WITH {_ROWS}, o AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY id) AS n FROM rows)
        SELECT company_id, {', '.join(f'arg_max({f}, id) FILTER ({f} IS NOT NULL) AS {out}' for f, out in SV.FIELDS.items())},
               arg_max(CASE WHEN n = 1 THEN fallback ELSE company_name END, id) FILTER (n = 1 OR company_name IS NOT NULL) AS canonical_name,
               max(confidence) AS confidence FROM o GROUP BY company_id""",
    ["fx_observations"],
)
def survivorship_starter(spark, sf_dir):
    out = SV.merged_companies(_grouped(spark, sf_dir), variant="starter")
    return out.select("company_id", *SV.FIELDS.values(), "canonical_name", "confidence")


@query(
    "company_values",
    f"""WITH {_ROWS}, long AS (
            SELECT company_id, id, generate_subscripts(social_links, 1) - 1 AS i, 'social_profiles' AS field, unnest(social_links) AS value FROM rows
            UNION ALL SELECT company_id, id, 0, 'source_urls', source_url FROM rows)
        SELECT company_id, field, value, min(id) AS first_id, arg_min(i, id * 1000 + i) AS first_index FROM long WHERE value <> '' GROUP BY ALL""",
    ["fx_observations"],
)
def company_values(spark, sf_dir):
    return SV.company_values(_grouped(spark, sf_dir))


@query(
    "link_rows",
    f"""WITH {_ROWS} SELECT company_id, id AS observation_id, confidence AS match_score, '{{"resolver":"starter-merge-v1"}}' AS match_reason
        FROM rows WHERE NOT (id % 3 = 0)""",
    ["fx_observations"],
)
def link_rows(spark, sf_dir):
    rows = _grouped(spark, sf_dir)
    existing = rows.where(F.col("id") % 3 == 0).select("company_id", F.col("id").alias("observation_id"))
    return R.link_rows(rows, existing)


# Key graph closure: every key reaches every key of its component.
_COMPONENTS = f"""{_PREPARED}, keys AS (
    SELECT *, coalesce('d:' || primary_domain, 'n:' || coalesce(nullif(company_name, ''), fallback)) AS a,
           'n:' || coalesce(nullif(company_name, ''), fallback) AS b FROM prep
), edge AS (SELECT DISTINCT a, b FROM keys UNION SELECT DISTINCT b, a FROM keys),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
label AS (SELECT a, min(b) AS component FROM (SELECT a, b FROM reach UNION SELECT a, a FROM edge) GROUP BY a),
labelled AS (SELECT keys.*, component FROM keys JOIN label USING (a))"""


@query(
    "resolve_components",
    f"""WITH RECURSIVE {_COMPONENTS}
        SELECT id, min(id) OVER (PARTITION BY component) AS company_id FROM labelled""",
    ["fx_observations"],
)
def resolve_components(spark, sf_dir):
    return R.resolve_by_component(fx.observations(spark, sf_dir)).select("id", "company_id")


_FOLD = f"""{_COMPONENTS}, numbered AS (
    SELECT *, row_number() OVER (PARTITION BY component ORDER BY id) AS k FROM labelled
), fold(component, k, id, rank, st) AS (
    SELECT component, k, id, id, [{{'r': id, 'd': primary_domain, 'n': fallback, 'w': weight}}] FROM numbered WHERE k = 1
    UNION ALL
    SELECT component, k, id, coalesce(hit, id),
           CASE WHEN hit IS NULL THEN list_append(st, {{'r': id, 'd': d, 'n': fallback, 'w': w}})
                ELSE list_transform(st, lambda x: CASE WHEN x.r <> hit THEN x ELSE {{'r': x.r, 'd': coalesce(d, x.d),
                     'n': CASE WHEN name <> '' AND w > x.w THEN name ELSE x.n END, 'w': w}} END) END
    FROM (SELECT o.component, o.k, o.id, o.primary_domain AS d, o.company_name AS name, o.fallback, o.weight AS w, f.st,
                 list_min(list_transform(list_filter(f.st, lambda x: coalesce(x.d = o.primary_domain, false) OR coalesce(x.n = o.company_name, false)), lambda x: x.r)) AS hit
          FROM fold f JOIN numbered o ON o.component = f.component AND o.k = f.k + 1) s
), founders AS (SELECT rank, row_number() OVER (ORDER BY rank) AS company_id FROM (SELECT DISTINCT rank FROM fold)),
rows AS (SELECT prep.*, founders.company_id FROM prep JOIN fold USING (id) JOIN founders ON founders.rank = fold.rank)"""


@query("resolve_exact", f"WITH RECURSIVE {_FOLD} SELECT id, company_id FROM rows", ["fx_observations"])
def resolve_exact(spark, sf_dir):
    return R.assign_companies(fx.observations(spark, sf_dir)).select("id", "company_id")


@query(
    "resolved_companies",
    f"WITH RECURSIVE {_FOLD}, {_ORDERED} SELECT {_COMPANY} FROM ordered GROUP BY company_id",
    ["fx_observations"],
)
def resolved_companies(spark, sf_dir):
    out = R.resolve_observations(fx.observations(spark, sf_dir))
    return company_columns(out.companies.withColumnRenamed("id", "company_id"))
