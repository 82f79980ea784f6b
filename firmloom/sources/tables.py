"""Versioned parquet tables, keyed upsert, and the fetch, page and evidence stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from firmloom import schemas
from firmloom.functions.urls import hash_url

_MANIFEST = "version long, tag string, whole boolean"


# --- versioned tables --------------------------------------------------------
def _no_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty frame that the optimizer knows to be empty: what is joined to it isn't shuffled for that."""
    return spark.createDataFrame([], schema).limit(0)


def _versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).json(f"{root}/versions")
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in (problem.getCondition() or ""):
            raise
        return _no_rows(spark, _MANIFEST)


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the last published version, 0 if there is none."""
    return _versions(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType, before: str = "") -> DataFrame:
    """The table as of its last version: the last whole snapshot and what was appended since.

    With ``before``, the table as it was before the version of that tag, if there is one.
    """
    # One manifest row per version since the last whole snapshot reaches the driver.
    manifest = _versions(spark, root)
    if before:
        tagged = manifest.where(F.col("tag") == before).agg(F.min("version")).first()[0]
        manifest = manifest if tagged is None else manifest.where(F.col("version") < tagged)
    last = manifest.where("whole").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    live = [r.version for r in manifest.where(F.col("version") >= last).select("version").distinct().collect()]
    if not live:
        return _no_rows(spark, schema)
    return spark.read.schema(schema).parquet(*[f"{root}/v={v}" for v in sorted(live)])


def was_published(spark: SparkSession, root: str, tag: str) -> bool:
    return not _versions(spark, root).where(F.col("tag") == tag).isEmpty()


def _publish(df: DataFrame, root: str, tag: str, whole: bool) -> int:
    spark = df.sparkSession
    if tag and was_published(spark, root, tag):
        return current_version(spark, root)
    version = current_version(spark, root) + 1
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    spark.createDataFrame([(version, tag, whole)], _MANIFEST).coalesce(1).write.mode("append").json(f"{root}/versions")
    return version


def write_snapshot(df: DataFrame, root: str, tag: str = "") -> int:
    """Write the whole table as the next version, then publish its number.

    The path being read is never overwritten, so ``df`` may come from it.  A
    version that was written but not published is written again.  A non-empty
    ``tag`` that was published before makes this a no-op: replayed batches
    change nothing.
    """
    return _publish(df, root, tag, True)


def append_snapshot(rows: DataFrame, root: str, tag: str = "") -> int:
    """Publish a version that only adds ``rows``; costs the batch, not the table.

    ``write_snapshot(read_snapshot(...))`` folds the additions together again.
    """
    return _publish(rows, root, tag, False)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by ``keys``: later joins on them need no shuffle of it."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.TABLES[name])


def with_defaults(rows: DataFrame, schema: T.StructType, defaults: dict[str, object]) -> DataFrame:
    """All columns of ``schema``; absent ones and nulls take their default."""

    def value(field: T.StructField) -> Column:
        given = F.col(field.name) if field.name in rows.columns else F.lit(None)
        filled = F.coalesce(given, F.lit(defaults[field.name])) if field.name in defaults else given
        return filled.cast(field.dataType).alias(field.name)

    return rows.select(*[value(f) for f in schema.fields])


# --- keyed upsert ------------------------------------------------------------
def upsert(current: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Next state of a keyed table: the newest incoming row of a key, else the current row.

    Only the batch is aggregated; the current table just loses the rows whose
    key the batch holds.
    """
    columns = current.columns
    others = [c for c in columns if c != key]
    newest = incoming.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row")).select(key, "_row.*").select(*columns)
    touched = newest.select(F.col(key).alias("_key"))
    kept = current.join(touched, current[key].eqNullSafe(touched["_key"]), "left_anti")
    return kept.unionByName(newest)


def record_rows(records: DataFrame, key: str, now: Column) -> DataFrame:
    """(company_name, json, status, error_text, processed_at) of records, ready for the upsert."""
    whole = F.to_json(F.struct(*[c for c in records.columns if c != key]))
    return records.select(
        F.col(key).alias("company_name"), whole.alias("json"), "status", F.col("error").alias("error_text"),
        now.alias("processed_at"),
    )


# --- fetched pages -----------------------------------------------------------
def fetch_envelopes(leases: DataFrame, pages: DataFrame, on: str = "canonical_url") -> DataFrame:
    """Leases joined to what was fetched for them; ``ok`` tells success from failure.

    ``pages``: the join column, html, and where known status_code, final_url,
    content_type, latency_ms, error.  A missing page, an error, and an empty
    text are failures.
    """
    optional = {"status_code": "int", "final_url": "string", "content_type": "string", "latency_ms": "int", "error": "string"}
    shaped = pages.select(
        on, "html",
        *[(F.col(n) if n in pages.columns else F.lit(None).cast(t)).alias(n) for n, t in optional.items()],
    )
    joined = leases.join(shaped, on, "left")
    ok = F.col("error").isNull() & (F.length("html") > 0)
    return joined.withColumns(
        {
            "ok": F.coalesce(ok, F.lit(False)),
            "final_url": F.coalesce("final_url", "canonical_url"),
            "response_bytes": F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint"),
            "html_object_key": F.when(ok, F.concat("host", F.lit("/"), F.col("id").cast("string"), F.lit(".html"))),
        }
    )


def fetch_result_rows(envelopes: DataFrame, now: Column, meta: Column | None = None) -> DataFrame:
    """Rows of the fetch_results table, successes and failures in one pass.

    A failure keeps its reason; ``blocked`` stays false there.
    """
    ok = F.col("ok")
    reason = F.when(~ok, F.coalesce("error", F.lit("empty response")))
    success_meta = F.lit("{}") if meta is None else meta
    return envelopes.select(
        hash_url(F.col("canonical_url")).alias("url_hash"),
        now.alias("fetched_at"),
        F.lit("http").alias("worker_type"),
        F.lit("direct").alias("proxy_class"),
        *[F.when(ok, F.col(c)).alias(c) for c in ("status_code", "final_url", "content_type", "response_bytes", "latency_ms")],
        F.lit(False).alias("blocked"),
        reason.alias("block_reason"),
        F.when(ok, F.col("html_object_key")).alias("html_object_key"),
        F.when(ok, success_meta).otherwise(F.to_json(F.struct(reason.alias("error")))).alias("meta_json"),
    )


def store_bucket(key: str = "html_object_key", buckets: int = 1024) -> Column:
    """Storage bucket of an object key, by its host part."""
    return F.pmod(F.xxhash64(F.substring_index(key, "/", 1)), F.lit(buckets)).cast("int")


def raw_page_rows(envelopes: DataFrame, buckets: int = 1024) -> DataFrame:
    """(html_object_key, html, bucket) of the successful fetches; write it partitioned by bucket."""
    good = envelopes.where("ok").select("html_object_key", "html")
    return good.withColumn("bucket", store_bucket("html_object_key", buckets))


def decode_html(payload: Column) -> Column:
    """Stored bytes as text; undecodable ones are replaced."""
    return F.decode(payload, "UTF-8")


def html_for(messages: DataFrame, raw_pages: DataFrame) -> DataFrame:
    """Look the page text up by its object key (and storage bucket, where the store has one)."""
    if "bucket" in raw_pages.columns and "bucket" in messages.columns:
        return messages.join(raw_pages, ["bucket", "html_object_key"])
    return messages.join(raw_pages.select("html_object_key", "html"), "html_object_key")


def evidence_rows(parsed: DataFrame, observation: Sequence[str], metadata: Sequence[str], host: str = "host", key: str = "id") -> DataFrame:
    """(evidence_object_key, payload): observation and metadata of a page as one JSON text."""
    payload = F.to_json(F.struct(F.struct(*observation).alias("observation"), F.struct(*metadata).alias("metadata")))
    name = F.concat(F.col(host), F.lit("/"), F.col(key).cast("string"), F.lit(".json"))
    return parsed.select(name.alias("evidence_object_key"), payload.alias("payload"))


def observations_of_evidence(evidence: DataFrame, observation: T.StructType) -> DataFrame:
    """Observations read back from stored evidence: evidence_object_key and the columns of ``observation``."""
    shape = T.StructType([T.StructField("observation", observation)])
    read = evidence.select("evidence_object_key", F.from_json("payload", shape).alias("_read"))
    return read.select("evidence_object_key", "_read.observation.*")
