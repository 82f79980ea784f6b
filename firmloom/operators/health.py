"""Fetch-health statistics: outcome status, block guard, counters, host rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from firmloom.functions.constants import BLOCK_SIGNALS
from firmloom.functions.text import contains_any, first_nonempty, nonempty
from firmloom.operators.frontier import needs_browser
from firmloom.skew import CHUNK_ROWS, lookup_join, previous_value, running_totals

_BLOCKED_NOTE = "Detected blocking or challenge indicators in search/fetch results."
_EMPTY_NOTE = "Search completed but produced no result URLs."


def _details(error: Column, note: Column) -> Column:
    return F.nullif(F.concat_ws(" | ", F.nullif(error, F.lit("")), F.nullif(note, F.lit(""))), F.lit(""))


def _verdict(status: Column, details: Column, blocked: Column, result_count: Column) -> dict[str, Column]:
    given = F.when(nonempty(status), status).otherwise("failed")
    empty = (given == "ok") & (result_count == 0)
    return {
        "inferred_status": F.when(blocked, "blocked").when(empty, "failed").otherwise(given),
        "status_detail": F.when(blocked, F.coalesce(details, F.lit(_BLOCKED_NOTE)))
        .when(empty, F.coalesce(details, F.lit(_EMPTY_NOTE)))
        .otherwise(details),
    }


def infer_record_status(records: DataFrame) -> DataFrame:
    """Add inferred_status and status_detail to nested records; narrow, no shuffle."""

    def seen(item: Column) -> Column:
        final = F.coalesce(first_nonempty(item["metadata"]["final_url"], item["url"]), F.lit(""))
        return F.lower(F.concat(F.coalesce(item["title"], F.lit("")), F.lit(" "), final))

    details = _details(F.col("error"), F.col("note"))
    items = F.array_join(F.transform("results", seen), " ")
    text = F.concat_ws(" ", F.lower(details), items)
    columns = _verdict(F.col("status"), details, contains_any(text, BLOCK_SIGNALS), F.coalesce(F.size("results"), F.lit(0)))
    return records.withColumns(columns)


def infer_query_status(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """The same verdict from flat rows: tasks (query_id, status, error, note) and their results.

    Each result is judged by itself and the flags are summed, so no query is
    gathered anywhere.
    """
    final = F.coalesce(first_nonempty(F.col("final_url"), F.col("url")), F.lit(""))
    hit = contains_any(F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), final)), BLOCK_SIGNALS)
    flags = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.max(hit).alias("_hit"))
    joined = tasks.join(flags, "query_id", "left")
    details = _details(F.col("error"), F.col("note"))
    own = F.coalesce(contains_any(F.lower(details), BLOCK_SIGNALS), F.lit(False))
    blocked = own | F.coalesce("_hit", F.lit(False))
    return joined.withColumns(_verdict(F.col("status"), details, blocked, F.coalesce("_n", F.lit(0)))).drop("_n", "_hit")


def infer_joined_status(tasks: DataFrame, results: DataFrame, position: str = "seq", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """:func:`infer_record_status` from flat rows: a signal may also lie across the joint of two texts.

    ``tasks`` has query_id, status, error and note, ``results`` query_id, title,
    url, final_url and ``position``, a unique integer within the query above
    -2^62.  The texts of a query are its details, then its results by position,
    with a space in between.  A joint and a result hold a space each, so a
    signal with at most three reaches over two joints; each result is judged
    with the ends of the two texts before it, and no query is gathered.
    """
    longest = max(map(len, BLOCK_SIGNALS))
    if max(s.count(" ") for s in BLOCK_SIGNALS) > 3:
        raise ValueError("a signal of more than three spaces reaches over more than two joints")
    details = _details(F.col("error"), F.col("note"))
    final = F.coalesce(first_nonempty(F.col("final_url"), F.col("url")), F.lit(""))
    own = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), final))
    first = tasks.where(details.isNotNull()).select("query_id", F.lit(-(1 << 62)).alias("_at"), F.lower(details).alias("_text"), F.lit(0).alias("_one"))
    texts = first.unionByName(results.select("query_id", F.col(position).cast("bigint").alias("_at"), own.alias("_text"), F.lit(1).alias("_one")))
    ends = texts.select(
        "query_id", "_at", "_one", contains_any(F.col("_text"), BLOCK_SIGNALS).alias("_hit"),
        F.left("_text", F.lit(longest)).alias("_head"), F.right("_text", F.lit(longest)).alias("_tail"),
    )
    near = previous_value(ends, "query_id", "_at", "_tail", "_p1", chunk_rows)
    near = previous_value(near, "query_id", "_at", "_p1", "_p2", chunk_rows)
    # a text that was cut hides what it follows
    before = F.when(F.length("_p1") < longest, F.concat_ws(" ", "_p2", "_p1")).otherwise(F.col("_p1"))
    across = F.coalesce(contains_any(F.concat(before, F.lit(" "), F.col("_head")), BLOCK_SIGNALS), F.lit(False))
    flags = near.groupBy("query_id").agg(F.sum("_one").alias("_n"), F.max(F.col("_hit") | across).alias("_blocked"))
    joined = tasks.join(flags, "query_id", "left")
    verdict = _verdict(F.col("status"), details, F.coalesce("_blocked", F.lit(False)), F.coalesce("_n", F.lit(0)))
    return joined.withColumns(verdict).drop("_n", "_blocked")


def block_guard(
    outcomes: DataFrame, min_processed: int = 10, stop_rate: float = 0.20, run: str = "run_id", index: str = "idx",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Rows a run processes before it stops because too many were blocked.

    A run stops with the first row from ``min_processed`` on at which blocked /
    processed reaches ``stop_rate``; later rows are dropped.  ``index`` counts
    from 1 within its run.
    """
    counts = {"blocked_so_far": F.when(F.col("blocked"), 1).otherwise(0)}
    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    running = running_totals(outcomes, run, index, counts, **extra)
    tripped = (F.col(index) >= min_processed) & (F.col("blocked_so_far") / F.col(index) >= stop_rate)
    stops = running.where(tripped).groupBy(run).agg(F.min(index).alias("stop_idx"))
    joined = lookup_join(running, stops, run, F.col(index), counts=outcomes.groupBy(run).count())
    return joined.where(F.col("stop_idx").isNull() | (F.col(index) <= F.col("stop_idx")))


def outcome_counters(outcomes: DataFrame, total: int | None = None, by: str | None = None, order: str = "idx") -> DataFrame:
    """Completed, succeeded, failed, pending, and the last id and status; one row, or one per ``by``."""
    grouped = outcomes.groupBy(*([by] if by else []))
    done = F.count(F.lit(1))
    out = grouped.agg(
        done.alias("completed_count"),
        F.count_if(F.col("status") == "ok").alias("succeeded_count"),
        F.count_if(F.coalesce(F.col("status") != "ok", F.lit(True))).alias("failed_count"),
        F.max_by(F.struct(F.col("id").alias("id"), F.col("status").alias("status")), order).alias("_last"),
    )
    if total is not None:
        out = out.withColumn("total_count", F.lit(total).cast("bigint")).withColumn(
            "pending_count", F.col("total_count") - F.col("completed_count")
        )
    return out.withColumns({"last_id": F.col("_last.id"), "last_status": F.col("_last.status")}).drop("_last")


def host_rollup(fetches: DataFrame, recent: int = 20, order: str = "event_id") -> DataFrame:
    """Health of every host; ``ban_score`` is the blocked share of its ``recent`` last fetches.

    ``recent`` must stay below 1000: then Spark limits each host before the
    shuffle, and a host with very many fetches costs no more than any other.
    """
    if not 0 < recent < 1000:
        raise ValueError("recent must be between 1 and 999")
    totals = fetches.groupBy("host").agg(
        F.avg(F.when(F.col("status") == "ok", 1.0).otherwise(0.0)).alias("success_rate"),
        F.avg(F.when(F.col("blocked"), 1.0).otherwise(0.0)).alias("challenge_rate"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max(F.when(F.col("blocked"), F.col("fetched_at"))).alias("last_blocked_at"),
    )
    newest = W.partitionBy("host").orderBy(F.desc("fetched_at"), F.desc(order))
    last = fetches.select("host", "fetched_at", order, "blocked").withColumn("_n", F.row_number().over(newest))
    bans = last.where(F.col("_n") <= recent).groupBy("host").agg(
        F.avg(F.when(F.col("blocked"), 1.0).otherwise(0.0)).alias("ban_score")
    )
    return totals.join(bans, "host")


def latest_fetches(fetches: DataFrame, order: str = "event_id") -> DataFrame:
    """The newest fetch of every URL, as an aggregate with map-side reduction."""
    others = [c for c in fetches.columns if c != "url_hash"]
    newest = fetches.groupBy("url_hash").agg(F.max_by(F.struct(*others), F.struct("fetched_at", order)).alias("_row"))
    return newest.select("url_hash", "_row.*")


def with_preferred_mode(rollup: DataFrame) -> DataFrame:
    """Browser for hosts that challenge or ban often, else plain fetching."""
    browser = needs_browser(F.lit("http"), F.col("challenge_rate"), F.col("ban_score"))
    return rollup.withColumn("preferred_render_mode", F.when(browser, "browser").otherwise("http"))
