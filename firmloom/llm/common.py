"""Small helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmloom.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_CLASS = r"\x20\x09-\x0D"
#: Most rows of a table that joins may copy to every executor (a few ids each: at most some 50 MB).
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """Hash that tells apart texts under one id (0 for null); joins use it next to the id."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text)).cast("long")


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    met = F.lit(True)
    for n in names:
        met = met & left[n].eqNullSafe(right[n])
    return met


#: Spark's own setting that removes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write go with its end, as nothing reads them after it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``stored`` returned, once no table reads them any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("llm-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hinted(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (stored, narrow) with a broadcast hint if a count shows at most ``max_rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= max_rows else df


def with_columns_first(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = list(names)
    return df.select(*names, *[c for c in df.columns if c not in names])


#: Bits of a hashed set: 8 MB wherever it is used, whatever the size of the data.
HASHED_BITS = 26


def hashed_set(hashes: DataFrame) -> np.ndarray:
    """Bitmap of a one-column table of 64-bit hashes, of fixed size.

    ``may_hold`` finds every member; it takes others for members as often as
    bits are set, so a larger set costs later work and never a result.  One row
    per 64 bits at most reaches the driver.
    """
    spot = hashes.select(F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << HASHED_BITS) - 1)).alias("spot"))
    words = spot.groupBy(F.shiftright("spot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, int(spot & 63)))").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (HASHED_BITS - 6), np.uint64)
    bitmap[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each 64-bit hash, whether the set may hold it (never False for a member)."""
    spot = hashes.view(np.uint64) & np.uint64((1 << HASHED_BITS) - 1)
    return (bitmap[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
