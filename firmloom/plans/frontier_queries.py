"""URL and frontier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmloom.functions import urls as U
from firmloom.functions.constants import DIRECTORY_DOMAINS, PROFILE_PAGE_HINTS, SEARCH_BLOCKED_PREFIXES
from firmloom.operators import frontier as FR
from firmloom.plans import fixtures as fx
from firmloom.plans.fixtures_sql import (
    NOW,
    any_of,
    canonical_url,
    first_match,
    render_mode,
    score,
    source_type,
    url_parts,
)
from firmloom.plans.registry import query

_P = url_parts("canonical_url")
_PARTS_SQL = ", ".join(f"{_P[k]} AS {k}" for k in ("url_hash", "scheme", "host", "etld1", "path", "query_norm"))
_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"


def ts_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query("url_components", f"SELECT id, canonical_url, {_PARTS_SQL} FROM fx_canon", ["fx_canon"])
def url_components(spark, sf_dir):
    rows = FR.with_url_columns(fx.seeds(spark, sf_dir))
    return rows.select("id", "canonical_url", "url_hash", "scheme", "host", "etld1", "path", "query_norm")


@query("url_components_starter", f"SELECT id, canonical_url, {_PARTS_SQL} FROM fx_canon_starter", ["fx_canon_starter"])
def url_components_starter(spark, sf_dir):
    rows = FR.with_url_columns(fx.seeds(spark, sf_dir), variant="starter")
    return rows.select("id", "canonical_url", "url_hash", "scheme", "host", "etld1", "path", "query_norm")


_RESULT_URL = """
    regexp_extract({u}, '^[^?#]*') || CASE WHEN contains({u}, '?') THEN '?' || array_to_string(list_transform(
        list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'),
            lambda f: NOT (contains({u}, 'youtube.com') AND split_part(f, '=', 1) = 't')
                  AND NOT (contains({u}, 'ford.com') AND split_part(f, '=', 1) = 'srsltid')),
        lambda f: split_part(f, '=', 1) || '=' || substr(f, instr(f, '=') + 1)), '&') ELSE '' END"""
_RESULT_INPUT = """
    SELECT page_id, CASE page_id % 3
        WHEN 0 THEN replace(url, '.example.', '.youtube.com.') || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&t=30&empty=' ELSE '?t=30&empty=' END
        WHEN 1 THEN replace(url, '.example.', '.Glassdoor.com.')
        ELSE replace(url, '/en/', '/support/') END AS u
    FROM pages"""


def _result_urls(spark, sf_dir):
    url = F.col("url")
    extra = F.when(url.contains("#"), "").when(url.contains("?"), "&t=30&empty=").otherwise("?t=30&empty=")
    on_video = F.concat(F.replace(url, F.lit(".example."), F.lit(".youtube.com.")), extra)
    u = (
        F.when(F.col("page_id") % 3 == 0, on_video)
        .when(F.col("page_id") % 3 == 1, F.replace(url, F.lit(".example."), F.lit(".Glassdoor.com.")))
        .otherwise(F.replace(url, F.lit("/en/"), F.lit("/support/")))
    )
    return fx.table(spark, sf_dir, "pages").select("page_id", u.alias("u"))


@query(
    "result_url_columns",
    f"""WITH i AS ({_RESULT_INPUT}), n AS (SELECT page_id, {_RESULT_URL.format(u='u')} AS normalized FROM i),
        d AS (SELECT *, regexp_extract(normalized, '^[^:]*://([^/?#]*)', 1) AS domain FROM n)
        SELECT page_id, normalized, domain, {any_of('lower(domain)', DIRECTORY_DOMAINS)} AS is_directory,
               CASE WHEN {any_of('lower(domain)', DIRECTORY_DOMAINS)} THEN 'aggregator_or_directory' ELSE 'likely_official' END AS classification,
               {first_match('lower(normalized)', PROFILE_PAGE_HINTS)} AS important_page,
               array_to_string(string_split(domain, '.')[-2:], '.') AS root_hint FROM d""",
)
def result_url_columns(spark, sf_dir):
    n = _result_urls(spark, sf_dir).select("page_id", U.normalize_result_url(F.col("u")).alias("normalized"))
    n = n.withColumn("domain", U.url_authority(F.col("normalized")))
    return n.select(
        "page_id", "normalized", "domain",
        (~U.is_likely_official_url(F.col("normalized"))).alias("is_directory"),
        U.classify_domain(F.col("domain")).alias("classification"),
        U.classify_important_page(F.col("normalized")).alias("important_page"),
        U.brand_domain_mapping(F.col("domain"), F.lit(None).cast("string"))["root_hint"].alias("root_hint"),
    )


_LIST_SQL = f"""
    WITH i AS ({_RESULT_INPUT}), h AS (
        SELECT page_id, unnest(['', u, u || '#again', 'https://www.google.com/search?q=' || page_id, 'https://b.example.org/' || page_id]) AS href,
               generate_subscripts([1, 2, 3, 4, 5], 1) AS n FROM i
    ), k AS (
        SELECT page_id, n, {_RESULT_URL.format(u='href')} AS url FROM h
        WHERE href <> '' AND NOT starts_with(href, 'https://www.google.')
        QUALIFY row_number() OVER (PARTITION BY page_id, {_RESULT_URL.format(u='href')} ORDER BY n) = 1
    )"""


def _unique_lists(spark, sf_dir):
    u = F.col("u")
    hrefs = F.array(
        F.lit(""), u, F.concat(u, F.lit("#again")),
        F.concat(F.lit("https://www.google.com/search?q="), F.col("page_id").cast("string")),
        F.concat(F.lit("https://b.example.org/"), F.col("page_id").cast("string")),
    )
    return _result_urls(spark, sf_dir).select(
        "page_id", U.extract_unique_urls(hrefs, SEARCH_BLOCKED_PREFIXES["google"]).alias("urls")
    )


@query("unique_result_urls", _LIST_SQL + " SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) AS pos, url FROM k")
def unique_result_urls(spark, sf_dir):
    out = _unique_lists(spark, sf_dir).select("page_id", F.posexplode("urls").alias("pos", "url"))
    return out.select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "url")


@query(
    "prioritized_result_urls",
    _LIST_SQL + f""" SELECT page_id, row_number() OVER (PARTITION BY page_id
        ORDER BY {any_of("lower(regexp_extract(url, '^[^:]*://([^/?#]*)', 1))", DIRECTORY_DOMAINS)}, n) AS pos, url FROM k""",
)
def prioritized_result_urls(spark, sf_dir):
    ranked = _unique_lists(spark, sf_dir).select("page_id", U.prioritize_urls(F.col("urls")).alias("urls"))
    out = ranked.select("page_id", F.posexplode("urls").alias("pos", "url"))
    return out.select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "url")


@query(
    "frontier_scores",
    f"""WITH t AS (SELECT id, canonical_url, depth, source_type AS given, {source_type('canonical_url', 'source_type')} AS source_type FROM fx_canon)
        SELECT id, source_type, {render_mode('canonical_url')} AS render_mode,
               {score('canonical_url', 'depth', 'source_type')} AS priority,
               (CASE WHEN given = 'manual_seed' THEN 100 ELSE greatest(10, 100 - depth * 5) END)::DOUBLE AS starter_priority,
               round(0.30 * (CASE WHEN given = 'manual_seed' THEN 1 ELSE 0 END)::DOUBLE + 0.15 * (length(canonical_url) % 7)::DOUBLE
                     - 0.05 * depth::DOUBLE, 6)::DOUBLE AS weighted
        FROM t""",
    ["fx_canon"],
)
def frontier_scores(spark, sf_dir):
    rows = fx.seeds(spark, sf_dir).withColumn("given", F.col("source_type"))
    built = FR.discovered_rows(rows, source_type=F.col("given"))
    signals = {
        "source_quality": F.when(F.col("given") == "manual_seed", 1).otherwise(0),
        "path_value": F.length("canonical_url") % 7,
        "depth": F.col("depth"),
    }
    return built.select(
        "id", "source_type", "render_mode", "priority",
        FR.starter_priority(F.col("depth"), F.col("given") == "manual_seed").alias("starter_priority"),
        F.round(FR.weighted_priority(signals), 6).alias("weighted"),
    )


@query(
    "seed_frontier",
    f"""WITH old AS (SELECT * FROM fx_frontier WHERE id % 3 <> 0), s AS (
            SELECT id AS position, canonical_url, {_PARTS_SQL} FROM fx_canon
            QUALIFY row_number() OVER (PARTITION BY url_hash ORDER BY id) = 1
        ), fresh AS (SELECT * FROM s WHERE url_hash NOT IN (SELECT url_hash FROM old))
        SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY position) AS id, canonical_url, url_hash,
               'manual_seed' AS source_type, 0 AS depth, {score('canonical_url', '0', "'manual_seed'")} AS priority, 'http' AS render_mode
        FROM fresh""",
    ["fx_canon", "fx_frontier"],
)
def seed_frontier(spark, sf_dir):
    old = fx.frontier(spark, sf_dir).where(F.col("id") % 3 != 0)
    seeds = fx.seeds(spark, sf_dir).select("url", F.col("id").alias("position"))
    _, new = FR.seed_urls(old, seeds, fx.now())
    return new.select("id", "canonical_url", "url_hash", "source_type", "depth", "priority", "render_mode")


_READY = f"state = 'ready' AND coalesce(next_fetch_at, {NOW}) <= {NOW}"


@query(
    "ready_candidates",
    f"SELECT id, host, priority FROM fx_frontier WHERE {_READY} AND render_mode = 'http' ORDER BY priority DESC, id LIMIT 50",
    ["fx_frontier"],
)
def ready_candidates(spark, sf_dir):
    return FR.ready_candidates(fx.frontier(spark, sf_dir), 50, fx.now()).select("id", "host", "priority")


def _leased_sql(limit: int, extra: str) -> str:
    return f"""WITH l AS (SELECT id FROM fx_frontier WHERE {_READY} {extra} ORDER BY priority DESC, id LIMIT {limit})
        SELECT id, CASE WHEN id IN (FROM l) THEN 'leased' ELSE state END AS state, render_mode,
               strftime(CASE WHEN id IN (FROM l) THEN {NOW} + INTERVAL 120 SECOND ELSE leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until
        FROM fx_frontier"""


@query("lease_ready", _leased_sql(40, "AND render_mode = 'http'"), ["fx_frontier"])
def lease_ready(spark, sf_dir):
    updated, _ = FR.lease_ready_urls(fx.frontier(spark, sf_dir), 40, 120, fx.now())
    return updated.select("id", "state", "render_mode", ts_text("leased_until"))


@query("lease_ready_starter", _leased_sql(10, ""), ["fx_frontier"])
def lease_ready_starter(spark, sf_dir):
    updated, _ = FR.lease_ready_urls(fx.frontier(spark, sf_dir), 10, 120, fx.now(), render_mode=None)
    return updated.select("id", "state", "render_mode", ts_text("leased_until"))


@query(
    "lease_specific",
    f"""SELECT id, CASE WHEN id % 4 = 2 AND state = 'ready' THEN 'leased' ELSE state END AS state,
               strftime(CASE WHEN id % 4 = 2 AND state = 'ready' THEN {NOW} + INTERVAL 120 SECOND ELSE leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until
        FROM fx_frontier""",
    ["fx_frontier"],
)
def lease_specific(spark, sf_dir):
    rows = fx.frontier(spark, sf_dir)
    updated, _ = FR.lease_specific_urls(rows, rows.where(F.col("id") % 4 == 2), 120, fx.now())
    return updated.select("id", "state", ts_text("leased_until"))


_BUDGETS = """b AS (
    SELECT h.host, coalesce(d.crawl_delay_ms, 1000) AS crawl_delay_ms, coalesce(d.max_parallelism, 2) AS max_parallelism,
           coalesce(d.preferred_render_mode, 'http') AS preferred_render_mode, coalesce(d.ban_score, 0.0)::DOUBLE AS ban_score,
           coalesce(d.challenge_rate, 0.0)::DOUBLE AS challenge_rate
    FROM (SELECT DISTINCT host FROM fx_frontier) h LEFT JOIN fx_domain_state d USING (host))"""


@query("domain_budgets", f"WITH {_BUDGETS} SELECT * FROM b", ["fx_frontier", "fx_domain_state"])
def domain_budgets(spark, sf_dir):
    return FR.domain_budgets(fx.frontier(spark, sf_dir), fx.domain_state(spark, sf_dir))


def _decisions_sql(limit: int) -> str:
    return f"""{_BUDGETS}, c AS (
        SELECT * FROM fx_frontier WHERE {_READY} AND render_mode = 'http' ORDER BY priority DESC, id LIMIT {limit * 5}
    ), p AS (
        SELECT c.*, b.max_parallelism, (b.preferred_render_mode = 'browser' OR b.challenge_rate >= 0.2 OR b.ban_score >= 0.5) AS promote
        FROM c JOIN b USING (host)
    ), q AS (
        SELECT id FROM p WHERE NOT promote
        QUALIFY row_number() OVER (PARTITION BY host ORDER BY priority DESC, id) <= max_parallelism
    ), s AS (SELECT id FROM p WHERE id IN (FROM q) ORDER BY priority DESC, id LIMIT {limit}),
    decided AS (
        SELECT id, host, priority, CASE WHEN promote THEN 'promoted' WHEN id IN (FROM s) THEN 'leased' ELSE 'deferred' END AS decision FROM p
    )"""


@query("schedule_batch", f"WITH {_decisions_sql(40)} SELECT * FROM decided", ["fx_frontier", "fx_domain_state"])
def schedule_batch(spark, sf_dir):
    out = FR.schedule_decisions(fx.frontier(spark, sf_dir), fx.domain_state(spark, sf_dir), 40, fx.now())
    return out.select("id", "host", "priority", "decision")


@query(
    "schedule_applied",
    f"""WITH {_decisions_sql(40)}
        SELECT f.id, CASE d.decision WHEN 'leased' THEN 'leased' WHEN 'promoted' THEN 'ready' ELSE state END AS state,
               CASE WHEN d.decision = 'promoted' THEN 'browser' ELSE render_mode END AS render_mode,
               strftime(CASE d.decision WHEN 'leased' THEN {NOW} + INTERVAL 120 SECOND WHEN 'promoted' THEN NULL ELSE leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until,
               strftime(CASE WHEN d.decision = 'promoted' THEN {NOW} ELSE next_fetch_at END, '%Y-%m-%d %H:%M:%S') AS next_fetch_at
        FROM fx_frontier f LEFT JOIN decided d ON f.id = d.id""",
    ["fx_frontier", "fx_domain_state"],
)
def schedule_applied(spark, sf_dir):
    batch = FR.schedule_ready_urls(fx.frontier(spark, sf_dir), fx.domain_state(spark, sf_dir), 40, 120, fx.now())
    return batch.frontier.select("id", "state", "render_mode", ts_text("leased_until"), ts_text("next_fetch_at"))


@query(
    "promote_to_browser",
    f"""SELECT id, CASE WHEN id % 6 = 2 THEN 'ready' ELSE state END AS state,
               CASE WHEN id % 6 = 2 THEN 'browser' ELSE render_mode END AS render_mode,
               strftime(CASE WHEN id % 6 = 2 THEN {NOW} ELSE next_fetch_at END, '%Y-%m-%d %H:%M:%S') AS next_fetch_at,
               strftime(CASE WHEN id % 6 <> 2 THEN leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until
        FROM fx_frontier""",
    ["fx_frontier"],
)
def promote_to_browser(spark, sf_dir):
    rows = fx.frontier(spark, sf_dir)
    updated = FR.promote_urls_to_browser(rows, rows.where(F.col("id") % 6 == 2), fx.now())
    return updated.select("id", "state", "render_mode", ts_text("next_fetch_at"), ts_text("leased_until"))


@query(
    "fetch_outcomes",
    f"""SELECT id, CASE WHEN state = 'leased' AND id % 4 < 2 THEN 'fetched' WHEN state = 'leased' AND id % 4 = 2 THEN 'ready' ELSE state END AS state,
               CASE WHEN state = 'leased' AND id % 4 = 2 THEN retry_count + 1 ELSE retry_count END AS retry_count,
               CASE WHEN state = 'leased' AND id % 4 < 2 THEN 200 + id % 3 ELSE http_status END::INT AS http_status,
               strftime(CASE WHEN state = 'leased' AND id % 4 = 2 THEN {NOW} + INTERVAL 300 SECOND ELSE next_fetch_at END, '%Y-%m-%d %H:%M:%S') AS next_fetch_at,
               strftime(CASE WHEN NOT (state = 'leased' AND id % 4 < 3) THEN leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until,
               strftime(CASE WHEN state = 'leased' AND id % 4 < 2 THEN {NOW} ELSE last_fetched_at END, '%Y-%m-%d %H:%M:%S') AS last_fetched_at
        FROM fx_frontier""",
    ["fx_frontier"],
)
def fetch_outcomes(spark, sf_dir):
    rows = fx.frontier(spark, sf_dir)
    i = F.col("id")
    outcomes = rows.where((F.col("state") == "leased") & (i % 4 < 3)).select(
        "id", (i % 4 < 2).alias("ok"), (i % 3 + 200).cast("int").alias("status_code")
    )
    out = FR.apply_fetch_outcomes(rows, outcomes, fx.now())
    return out.select(
        "id", "state", "retry_count", "http_status", ts_text("next_fetch_at"), ts_text("leased_until"), ts_text("last_fetched_at")
    )


@query(
    "pending_tasks",
    """SELECT c_custkey AS query_id, c_name AS query FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def pending_tasks(spark, sf_dir):
    tasks = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id"), F.col("c_name").alias("query"))
    done = fx.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("query_id"))
    return FR.pending_tasks(tasks, done)


@query(
    "recrawl_due",
    """SELECT id, f.host, strftime(last_fetched_at + to_hours(coalesce(recrawl_interval_hours, 168)), '%Y-%m-%d %H:%M:%S') AS recrawl_at
       FROM fx_frontier f LEFT JOIN fx_domain_state d ON f.host = d.host WHERE state = 'fetched'""",
    ["fx_frontier", "fx_domain_state"],
)
def recrawl_due(spark, sf_dir):
    return FR.recrawl_due(fx.frontier(spark, sf_dir), fx.domain_state(spark, sf_dir)).select("id", "host", ts_text("recrawl_at"))


@query(
    "reclaim_expired",
    f"""SELECT id, CASE WHEN state = 'leased' AND leased_until < {NOW} THEN 'ready' ELSE state END AS state,
               strftime(CASE WHEN NOT (state = 'leased' AND coalesce(leased_until < {NOW}, false)) THEN leased_until END, '%Y-%m-%d %H:%M:%S') AS leased_until
        FROM fx_frontier""",
    ["fx_frontier"],
)
def reclaim_expired(spark, sf_dir):
    return FR.reclaim_expired_leases(fx.frontier(spark, sf_dir), fx.now()).select("id", "state", ts_text("leased_until"))
