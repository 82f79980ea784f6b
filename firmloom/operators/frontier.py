"""The crawl frontier: scoring, insert-if-absent, quota scheduling, state changes."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from firmloom import schemas
from firmloom.functions.constants import (
    BROWSER_HINTS,
    HIGH_VALUE_HINTS,
    IMPORTANT_SOURCE_TYPES,
    LOW_VALUE_HINTS,
    SIGNAL_WEIGHTS,
    STARTER_TRACKING_PARAMS,
    TRACKING_PARAMS,
)
from firmloom.functions.text import contains_any, first_of
from firmloom.functions.urls import (
    canonicalize_url,
    extract_host,
    first_matching,
    guess_etld1,
    hash_canonical,
    url_path,
    url_query,
    url_scheme,
)
from firmloom.session import cut_lineage
from firmloom.skew import CHUNK_ROWS, lookup_join, number_rows

FRONTIER_ROW = ("id", "canonical_url", "host", "render_mode", "depth", "priority", "source_type")


# --- scoring -----------------------------------------------------------------
def score_url(url: Column, depth: Column, source_type: Column) -> Column:
    lowered = F.lower(url)
    score = (
        F.lit(100.0)
        + F.when(source_type == "manual_seed", 40.0).otherwise(0.0)
        + F.when(contains_any(lowered, HIGH_VALUE_HINTS), 35.0).otherwise(0.0)
        - F.when(contains_any(lowered, LOW_VALUE_HINTS), 30.0).otherwise(0.0)
        - F.least(depth * 5, F.lit(40))
    )
    return F.greatest(score, F.lit(5.0))


def starter_priority(depth: Column, is_seed: Column) -> Column:
    return F.when(is_seed, F.lit(100.0)).otherwise(F.greatest(F.lit(10), F.lit(100) - depth * 5).cast("double"))


def weighted_priority(signals: dict[str, Column]) -> Column:
    """Weighted sum of the eight documented signals; a missing signal counts 0."""
    total = F.lit(0.0)
    for name, weight in SIGNAL_WEIGHTS.items():
        if name in signals:
            total = total + F.lit(weight) * F.coalesce(signals[name].cast("double"), F.lit(0.0))
    return total


def derive_source_type(url: Column, source_type: Column) -> Column:
    """A discovered link to an important page is told apart by its path."""
    hinted = first_matching(F.lower(url), IMPORTANT_SOURCE_TYPES)
    return F.when(source_type == "discovered_link", F.coalesce(hinted, source_type)).otherwise(source_type)


def derive_render_mode(url: Column) -> Column:
    return F.when(contains_any(F.lower(url), BROWSER_HINTS), "browser").otherwise("http")


# --- building frontier rows --------------------------------------------------
def with_url_columns(rows: DataFrame, url: str = "url", variant: str = "staged") -> DataFrame:
    """Add canonical_url, url_hash, scheme, host, etld1, path and query_norm."""
    tracking = STARTER_TRACKING_PARAMS if variant == "starter" else TRACKING_PARAMS
    canonical = rows.withColumn("canonical_url", canonicalize_url(F.col(url), tracking))
    c = F.col("canonical_url")
    parts = canonical.select(
        "*",
        hash_canonical(c).alias("url_hash"),
        url_scheme(c).alias("scheme"),
        extract_host(c).alias("host"),
        F.when(url_path(c) == "", "/").otherwise(url_path(c)).alias("path"),
        url_query(c).alias("query_norm"),
    )
    return parts.withColumn("etld1", guess_etld1(F.col("host")))


def seed_rows(rows: DataFrame, url: str = "url", source_type: str = "manual_seed", variant: str = "staged") -> DataFrame:
    """Frontier columns of seed URLs: depth 0, ready, plain fetch."""
    built = with_url_columns(rows, url, variant).withColumns(
        {"source_type": F.lit(source_type), "depth": F.lit(0), "state": F.lit("ready"), "render_mode": F.lit("http")}
    )
    if variant == "starter":
        return built.withColumn("priority", starter_priority(F.col("depth"), F.lit(True)))
    return built.withColumn("priority", score_url(F.col("canonical_url"), F.col("depth"), F.col("source_type")))


def discovered_rows(
    rows: DataFrame, url: str = "url", source_type: Column | None = None, variant: str = "staged"
) -> DataFrame:
    """Frontier columns of discovered links; ``rows`` carries their ``depth``."""
    given = F.lit("discovered_link") if source_type is None else source_type
    built = with_url_columns(rows.withColumn("source_type", given), url, variant).withColumn("state", F.lit("ready"))
    if variant == "starter":
        return built.withColumns(
            {"render_mode": F.lit("http"), "priority": starter_priority(F.col("depth"), F.lit(False))}
        )
    c = F.col("canonical_url")
    built = built.withColumns(
        {"source_type": derive_source_type(c, F.col("source_type")), "render_mode": derive_render_mode(c)}
    )
    return built.withColumn("priority", score_url(c, F.col("depth"), F.col("source_type")))


def explode_links(pages: DataFrame, links: str, position: str, max_links: int | None = 50) -> DataFrame:
    """One row per kept link of a page (``max_links=None``: all), ``depth`` one deeper; order is (position, link_no)."""
    return pages.select(
        F.col(position).alias("position"),
        (F.col("depth") + 1).cast("int").alias("depth"),
        F.posexplode(first_of(F.col(links), max_links)).alias("link_no", "url"),
    )


# --- insert-if-absent --------------------------------------------------------
def first_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Earliest row of every key.  An aggregate, so duplicates collapse before the shuffle."""
    others = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return picked.select(key, "_row.*").select(*rows.columns)


def absent_rows(existing: DataFrame, incoming: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``incoming`` (unique on ``key``) whose key is not in ``existing``.

    The large side is only probed for the keys of the batch: when the batch is
    small enough for Spark to broadcast its keys, the existing table is scanned
    (key column only) and not shuffled.
    """
    keys = [key] if isinstance(key, str) else key
    hits = existing.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    return incoming.join(hits, keys, "left_anti")


def insert_if_absent(
    frontier: DataFrame, rows: DataFrame, now: Column, position: str = "position", ties: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Add the rows whose ``url_hash`` is new; the first arrival of a hash wins.

    Returns (frontier with the new rows, the new rows).  New ids continue after
    the largest existing one, in arrival order.  The count of the second frame
    is the number inserted.
    """
    # Both frames are read twice below: the batch must be made, and the frontier probed, only once.
    firsts = cut_lineage(first_per_key(rows, "url_hash", [position, *ties]))
    fresh = cut_lineage(absent_rows(frontier, firsts, "url_hash"))
    top = F.coalesce(frontier.agg(F.max("id")).scalar(), F.lit(0))
    # With ties a position has several rows (the links of a page), so fewer positions make a chunk.
    numbered = number_rows(fresh, position, ties, "_number", chunk_rows=CHUNK_ROWS // 10 if ties else CHUNK_ROWS)
    numbered = numbered.withColumn("id", top + F.col("_number"))
    types = {f.name: f.dataType for f in schemas.URLS}
    stamped = {"next_fetch_at": now, "created_at": now, "updated_at": now}

    def value(name: str) -> Column:
        if name in numbered.columns:
            col = F.col(name)
        elif name in stamped:
            col = stamped[name]
        else:
            col = F.lit(schemas.URL_DEFAULTS.get(name))
        return col.cast(types.get(name, "string")).alias(name)

    new = numbered.select(*[value(name) for name in frontier.columns])
    return frontier.unionByName(new), new


def seed_urls(
    frontier: DataFrame, seeds: DataFrame, now: Column, url: str = "url", position: str = "position",
    source_type: str = "manual_seed", variant: str = "staged",
) -> tuple[DataFrame, DataFrame]:
    return insert_if_absent(frontier, seed_rows(seeds, url, source_type, variant), now, position)


def add_discovered_urls(
    frontier: DataFrame, links: DataFrame, now: Column, position: str = "position", ties: Sequence[str] = ("link_no",),
    variant: str = "staged",
) -> tuple[DataFrame, DataFrame]:
    """``links`` as made by :func:`explode_links`; the first arrival keeps its depth.

    Pages of a host repeat their links, so only the first of each text is taken apart;
    the first of all spellings of a URL is among them.
    """
    firsts = first_per_key(links, "url", [position, *ties])
    return insert_if_absent(frontier, discovered_rows(firsts, variant=variant), now, position, ties)


# --- selection ---------------------------------------------------------------
def ready_candidates(frontier: DataFrame, limit: int, now: Column, render_mode: str | None = "http") -> DataFrame:
    """Due, ready URLs, best priority first; ``render_mode=None`` takes every mode."""
    due = (F.col("state") == "ready") & (F.coalesce(F.col("next_fetch_at"), now) <= now)
    if render_mode is not None:
        due = due & (F.col("render_mode") == render_mode)
    return frontier.where(due).select(*FRONTIER_ROW).orderBy(F.desc("priority"), F.asc("id")).limit(limit)


def _update_by_id(frontier: DataFrame, ids: DataFrame, changes: dict[str, Column], broadcast: bool) -> DataFrame:
    """Set columns on the rows whose id is in ``ids``; every other row is copied."""
    marked = ids.withColumn("_hit", F.lit(True))
    joined = frontier.join(F.broadcast(marked) if broadcast else marked, "id", "left")
    hit = F.col("_hit").isNotNull()
    updated = joined.withColumns({k: F.when(hit, v).otherwise(F.col(k)) for k, v in changes.items()})
    return updated.select(*frontier.columns)


def _lease_changes(now: Column, lease_seconds: int) -> dict[str, Column]:
    until = now + F.make_interval(secs=F.lit(lease_seconds))
    return {"state": F.lit("leased"), "leased_until": until, "updated_at": now}


def _present(frontier: DataFrame, changes: dict[str, Column]) -> dict[str, Column]:
    return {k: v for k, v in changes.items() if k in frontier.columns}


def lease_ready_urls(
    frontier: DataFrame, limit: int, lease_seconds: int, now: Column, render_mode: str | None = "http"
) -> tuple[DataFrame, DataFrame]:
    """(frontier with the best ``limit`` URLs leased, the leased rows)."""
    leased = ready_candidates(frontier, limit, now, render_mode)
    changes = _present(frontier, _lease_changes(now, lease_seconds))
    return _update_by_id(frontier, leased.select("id"), changes, broadcast=True), leased


def lease_specific_urls(
    frontier: DataFrame, ids: DataFrame, lease_seconds: int, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Lease the given ids, those that are still ready."""
    ready = frontier.where(F.col("state") == "ready")
    leased = ready.join(ids.select("id").distinct(), "id", "left_semi").select(*FRONTIER_ROW)
    changes = _present(frontier, _lease_changes(now, lease_seconds))
    return _update_by_id(frontier, leased.select("id"), changes, broadcast=False), leased


def domain_budgets(hosts: DataFrame, domain_state: DataFrame, bounded: bool = False) -> DataFrame:
    """Fetch policy of every distinct host, with defaults where the host has no row.

    ``bounded``: the hosts are few by construction (a batch), so the policy
    table is scanned against a broadcast of them and never shuffled.
    """
    names = list(schemas.UNKNOWN_HOST_BUDGET)
    distinct = hosts.select("host").distinct()
    few = F.broadcast(distinct) if bounded else distinct
    known = domain_state.join(few, "host", "left_semi").select("host", *names, F.lit(True).alias("_known"))
    joined = distinct.join(F.broadcast(known) if bounded else known, "host", "left")

    def policy(name: str) -> Column:
        stored = F.coalesce(F.col(name), F.lit(schemas.DOMAIN_STATE_DEFAULTS[name]))
        return F.when(F.col("_known"), stored).otherwise(F.lit(schemas.UNKNOWN_HOST_BUDGET[name])).alias(name)

    return joined.select("host", *[policy(n) for n in names])


def needs_browser(preferred_render_mode: Column, challenge_rate: Column, ban_score: Column) -> Column:
    return (preferred_render_mode == "browser") | (challenge_rate >= 0.2) | (ban_score >= 0.5)


class ScheduledBatch(NamedTuple):
    frontier: DataFrame
    decisions: DataFrame


def schedule_decisions(
    frontier: DataFrame, domain_state: DataFrame, limit: int, now: Column, render_mode: str = "http"
) -> DataFrame:
    """Candidates (five times ``limit``) with ``decision`` leased, deferred or promoted.

    At most ``5 * limit`` rows leave the first step, so both ranks below and
    the broadcasts are bounded by an argument, not by the data.
    """
    # Kept, so that the frontier is scanned once although the candidates are read twice.
    candidates = cut_lineage(ready_candidates(frontier, limit * 5, now, render_mode))
    budgets = domain_budgets(candidates, domain_state, bounded=True)
    joined = candidates.join(F.broadcast(budgets), "host", "left")
    browser = needs_browser(F.col("preferred_render_mode"), F.col("challenge_rate"), F.col("ban_score"))
    marked = joined.withColumn("_promote", browser & (F.col("render_mode") != "browser"))
    by_host = W.partitionBy("host", "_promote").orderBy(F.desc("priority"), F.asc("id"))
    ranked = marked.withColumn("_in_quota", ~F.col("_promote") & (F.row_number().over(by_host) <= F.col("max_parallelism")))
    overall = W.partitionBy("_in_quota").orderBy(F.desc("priority"), F.asc("id"))
    decision = (
        F.when(F.col("_promote"), "promoted")
        .when(F.col("_in_quota") & (F.row_number().over(overall) <= limit), "leased")
        .otherwise("deferred")
    )
    return ranked.withColumn("decision", decision).select(*FRONTIER_ROW, "decision")


def schedule_ready_urls(
    frontier: DataFrame, domain_state: DataFrame, limit: int, lease_seconds: int, now: Column, render_mode: str = "http"
) -> ScheduledBatch:
    """Decide a batch and apply it: leases set, promoted rows moved to browser mode."""
    decisions = schedule_decisions(frontier, domain_state, limit, now, render_mode)
    acted = decisions.where(F.col("decision") != "deferred").select("id", F.col("decision").alias("_decision"))
    joined = frontier.join(F.broadcast(acted), "id", "left")
    leased, promoted = F.col("_decision") == "leased", F.col("_decision") == "promoted"
    until = now + F.make_interval(secs=F.lit(lease_seconds))
    changes = {
        "state": F.when(leased, "leased").when(promoted, "ready").otherwise(F.col("state")),
        "render_mode": F.when(promoted, "browser").otherwise(F.col("render_mode")),
        "leased_until": F.when(leased, until).when(~promoted | promoted.isNull(), F.col("leased_until")),
        "next_fetch_at": F.when(promoted, now).otherwise(F.col("next_fetch_at")),
    }
    if "updated_at" in frontier.columns:
        changes["updated_at"] = F.when(leased | promoted, now).otherwise(F.col("updated_at"))
    return ScheduledBatch(joined.withColumns(changes).select(*frontier.columns), decisions)


def promote_urls_to_browser(frontier: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    changes = {
        "render_mode": F.lit("browser"), "state": F.lit("ready"), "leased_until": F.lit(None).cast("timestamp"),
        "next_fetch_at": now, "updated_at": now,
    }
    return _update_by_id(frontier, ids.select("id").distinct(), _present(frontier, changes), broadcast=False)


# --- outcomes ----------------------------------------------------------------
def apply_fetch_outcomes(
    frontier: DataFrame, outcomes: DataFrame, now: Column, retry_delay_seconds: int = 300, max_retries: int | None = None
) -> DataFrame:
    """Move fetched rows to ``fetched`` and failed ones back to ``ready`` with a fixed delay.

    ``outcomes``: one row per id with ``ok`` (boolean) and ``status_code``.
    There is no retry cap unless ``max_retries`` is given; rows beyond it become
    ``failed``.
    """
    joined = frontier.join(outcomes.select("id", F.col("ok").alias("_ok"), F.col("status_code").alias("_code")), "id", "left")
    ok, failed = F.col("_ok"), ~F.col("_ok")
    again = F.lit("ready")
    if max_retries is not None:
        again = F.when(F.col("retry_count") + 1 > max_retries, "failed").otherwise("ready")
    due = now + F.make_interval(secs=F.lit(retry_delay_seconds))
    no_time = F.lit(None).cast("timestamp")
    changes = {
        "state": F.when(ok, "fetched").when(failed, again).otherwise(F.col("state")),
        "leased_until": F.when(F.col("_ok").isNotNull(), no_time).otherwise(F.col("leased_until")),
        "last_fetched_at": F.when(ok, now).otherwise(F.col("last_fetched_at")),
        "http_status": F.when(ok, F.col("_code")).otherwise(F.col("http_status")),
        "retry_count": F.when(failed, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        "next_fetch_at": F.when(failed, due).otherwise(F.col("next_fetch_at")),
    }
    if "updated_at" in frontier.columns:
        changes["updated_at"] = F.when(F.col("_ok").isNotNull(), now).otherwise(F.col("updated_at"))
    return joined.withColumns(changes).select(*frontier.columns)


def pending_tasks(tasks: DataFrame, completed: DataFrame, key: str = "query_id") -> DataFrame:
    """Tasks without a completed record (resume)."""
    return tasks.join(completed.select(key), key, "left_anti")


def recrawl_due(frontier: DataFrame, domain_state: DataFrame) -> DataFrame:
    """Fetched rows with ``recrawl_at``: last fetch plus the host's recrawl interval."""
    hours = domain_state.select("host", F.col("recrawl_interval_hours").alias("_hours"))
    joined = lookup_join(frontier.where(F.col("state") == "fetched"), hours, "host", F.col("id"))
    interval = F.coalesce(F.col("_hours"), F.lit(schemas.DOMAIN_STATE_DEFAULTS["recrawl_interval_hours"]))
    return joined.withColumn("recrawl_at", F.col("last_fetched_at") + F.make_interval(hours=interval)).drop("_hours")


def reclaim_expired_leases(frontier: DataFrame, now: Column) -> DataFrame:
    expired = (F.col("state") == "leased") & (F.col("leased_until") < now)
    return frontier.withColumns(
        {
            "state": F.when(expired, "ready").otherwise(F.col("state")),
            "leased_until": F.when(~expired | expired.isNull(), F.col("leased_until")),
        }
    )
