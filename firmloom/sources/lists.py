"""Line-oriented inputs and outputs: seeds, queries, JSON records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from firmloom import schemas
from firmloom.functions.text import WHITESPACE_RUN


def _stripped(value: str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(value, rf"^{WHITESPACE_RUN}|{WHITESPACE_RUN}$", "")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line, stripped, blank lines dropped."""
    return spark.read.text(path).select(_stripped("value").alias("url")).where(F.col("url") != "")


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a text file, numbered from 1, without one task reading it all.

    Several files are numbered one after the other, by name.  Lines are counted
    per input split; a split's first number is the count of the splits before it.  Only one row per split goes through the sort.
    """
    lines = spark.read.text(path).select(
        "value", F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_n")
    )
    splits = lines.groupBy("_split").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = W.orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select("_split", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    joined = lines.join(starts, "_split")
    return joined.select((F.col("_before") + F.col("_n") - F.col("_first") + 1).alias("line_no"), "value")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query): the id is the line number; blank lines are skipped but counted."""
    lines = read_numbered_lines(spark, path).select(F.col("line_no").alias("query_id"), _stripped("value").alias("query"))
    return lines.where(F.col("query") != "")


def read_records(spark: SparkSession, path: str, schema: T.StructType = schemas.QUERY_RECORD) -> tuple[DataFrame, DataFrame]:
    """(good records, undecodable lines) of JSON lines; a missing path has neither."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    try:
        lines = spark.read.text(path).where(_stripped("value") != "")
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in (problem.getCondition() or ""):
            raise
        lines = spark.createDataFrame([], "value string")
    read = lines.select(F.from_json("value", marked, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    return read.where(F.col("_corrupt").isNull()).drop("_corrupt"), read.where(F.col("_corrupt").isNotNull()).select("_corrupt")


def completed_ids(records: DataFrame, only_ok: bool = False) -> DataFrame:
    """Distinct query ids that have a record; a failed one counts as done unless ``only_ok``."""
    done = records.where(F.col("query_id").isNotNull())
    if only_ok:
        done = done.where(F.col("status") == "ok")
    return done.select("query_id").distinct()


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def write_summary(records: DataFrame, path: str, single_file: bool = False) -> None:
    """All records as JSON; ``single_file`` only for outputs one task can write."""
    (records.coalesce(1) if single_file else records).write.mode("overwrite").json(path)
