"""Building blocks that stay even when one key holds a large share of the rows.

A window or a plain shuffle puts all rows of a key into one task.  The helpers
here cut every key into bounded pieces first, and carry only one summary row
per piece across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOT_KEY_ROWS = 1_000_000
CHUNK_ROWS = 1_000_000


def lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread: Column, hot_rows: int = HOT_KEY_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left join to a lookup with at most one row per ``key``, safe for hot keys.

    Keys with more than ``hot_rows`` rows are joined by broadcast: there can be
    at most ``count(rows) / hot_rows`` of them.  All other rows are shuffled on
    the key; rows of a hot or null key are spread over ``spread`` instead,
    because they need no partner there.  ``spread`` is a stored column with many
    values (an id), never a random one: a recomputed task must place its rows
    as before.  ``counts`` (key, count) saves counting when it is known.
    """
    values = [c for c in lookup.columns if c != key]
    if counts is None:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    hot_keys = counts.where(F.col("count") > hot_rows).select(key)
    hot = lookup.join(F.broadcast(hot_keys), key, "left_semi").select(
        F.col(key), F.struct(*values).alias("_hot"), F.lit(True).alias("_is_hot")
    )
    cold = lookup.select(F.col(key).alias("_cold_key"), F.struct(*values).alias("_cold"))
    with_hot = rows.join(F.broadcast(hot), key, "left")
    off_key = F.col("_is_hot").isNotNull() | F.col(key).isNull()
    scattered = F.concat(F.lit("\u0000"), spread.cast("string"))
    keyed = with_hot.withColumn(
        "_cold_key",
        F.when(off_key, F.coalesce(scattered, F.lit("\u0000"))).otherwise(F.col(key).cast("string")),
    )
    cold = cold.withColumn("_cold_key", F.col("_cold_key").cast("string"))
    joined = keyed.join(cold, "_cold_key", "left")
    picked = [F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values]
    return joined.select(*rows.columns, *picked)


def chunk_of(position: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    """First position of the chunk of a unique integer position; a chunk holds at most ``chunk_rows`` rows."""
    return position - F.pmod(position, F.lit(chunk_rows))


def previous_value(
    rows: DataFrame, group: str, position: str, value: str, out: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """``lag(value)`` per group in position order; ``position`` is a unique integer.

    Inside a chunk it is a plain lag.  The first row of a chunk takes the last
    value of the group's nearest earlier chunk, read from one row per chunk.
    """
    chunked = rows.withColumn("_chunk", chunk_of(F.col(position), chunk_rows))
    last = chunked.groupBy(group, "_chunk").agg(F.max_by(F.struct(F.col(value).alias("v")), position).alias("_last"))
    across = W.partitionBy(group).orderBy("_chunk")
    carried = last.select(group, "_chunk", F.lag("_last").over(across)["v"].alias("_carry"))
    inside = W.partitionBy(group, "_chunk").orderBy(position)
    local = chunked.withColumn("_first", F.row_number().over(inside) == 1).withColumn(
        "_lag", F.lag(value).over(inside)
    )
    return (
        local.join(carried, [group, "_chunk"])
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
        .drop("_chunk", "_carry", "_first", "_lag")
    )


def best_before(
    rows: DataFrame, group: str, position: str, value: str, out: str, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Largest ``value`` among the earlier rows of the group; null for its first row."""
    chunked = rows.withColumn("_chunk", chunk_of(F.col(position), chunk_rows))
    tops = chunked.groupBy(group, "_chunk").agg(F.max(value).alias("_top"))
    across = W.partitionBy(group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = tops.select(group, "_chunk", F.max("_top").over(across).alias("_carry"))
    inside = W.partitionBy(group, "_chunk").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    local = chunked.withColumn("_local", F.max(value).over(inside))
    joined = local.join(carried, [group, "_chunk"])
    return joined.withColumn(out, F.greatest("_local", "_carry")).drop("_chunk", "_carry", "_local")


def running_totals(
    rows: DataFrame, group: str, position: str, sums: dict[str, Column], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Running sums per group in position order; ``position`` is a unique integer within the group."""
    chunked = rows.withColumn("_chunk", chunk_of(F.col(position), chunk_rows))
    for name, value in sums.items():
        chunked = chunked.withColumn(f"_v_{name}", value)
    totals = chunked.groupBy(group, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = W.partitionBy(group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        group, "_chunk", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    inside = W.partitionBy(group, "_chunk").orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = chunked.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_s_{n}") for n in sums])
    joined = local.join(offsets, [group, "_chunk"])
    return joined.select(*rows.columns, *[(F.col(f"_s_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums])


def number_rows(
    rows: DataFrame, position: str, ties: Sequence[str], out: str, start: Column | int = 0, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Consecutive numbers ``start + 1, …`` in (position, ties) order, without one global sort.

    ``position`` is an id counted up from somewhere: the chunks it is cut into
    must be far fewer than the rows.
    """
    chunked = rows.withColumn("_chunk", chunk_of(F.col(position), chunk_rows))
    counts = chunked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    # One row per chunk: the only unpartitioned window, over count / chunk_rows rows.
    before = W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_chunk").orderBy(position, *ties)
    base = F.lit(start) if isinstance(start, int) else start
    return (
        chunked.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, "_chunk")
        .withColumn(out, (base + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_chunk", "_offset", "_rank")
    )
