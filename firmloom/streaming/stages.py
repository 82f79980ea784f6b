"""Stream stages: fetch events -> parsed documents -> frontier and companies."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from firmloom import schemas
from firmloom.operators import frontier as FR, health as HL, pages as PG, resolve as R, survivorship as SV
from firmloom.skew import number_rows
from firmloom.sources import tables as TB

FETCH_RESULTS_TOPIC = "fetch_results"
PARSED_DOCUMENTS_TOPIC = "parsed_documents"
#: Frontier ids whose whole documents one task sorts to number them.
CHUNK_DOCUMENTS = 50_000


# --- JSON messages -----------------------------------------------------------
def read_messages(spark: SparkSession, schema: T.StructType, fmt: str = "text", path: str | None = None, **options: str) -> DataFrame:
    """Stream of JSON messages with a fixed schema; undecodable ones are dropped.

    ``fmt="kafka"`` reads from the earliest offset, ``text`` reads files of one
    message per line.
    """
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    reader = spark.readStream.format(fmt).options(**options)
    return decode_messages(reader.load(path) if path else reader.load(), schema)


def decode_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    text = F.col("value").cast("string")
    return raw.select(F.from_json(text, schema).alias("m")).where(F.col("m").isNotNull()).select("m.*")


def encode_messages(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def write_messages(
    rows: DataFrame, checkpoint: str, fmt: str = "text", path: str | None = None, available_now: bool = False, **options: str
) -> StreamingQuery:
    """Send rows as JSON messages; the checkpoint makes a restart continue, not repeat."""
    writer = encode_messages(rows).writeStream.format(fmt).options(checkpointLocation=checkpoint, **options)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def fetch_events(envelopes: DataFrame) -> DataFrame:
    """One event per successful fetch."""
    return envelopes.where("ok").select(
        F.col("id").alias("frontier_id"), "canonical_url", "host", F.col("depth").cast("int").alias("depth"), "final_url",
        "html_object_key", "status_code", "content_type",
    )


# --- parse stage -------------------------------------------------------------
def parse_stage(events: DataFrame, raw_pages: DataFrame, max_links: int | None = 50) -> DataFrame:
    """Fetch events to parsed documents; a stream joined to the stored pages.

    With a bucketed store the events get the same bucket, so that a batch only
    reads the partitions its hosts live in.
    """
    if "bucket" in raw_pages.columns:
        events = events.withColumn("bucket", TB.store_bucket())
    pages = TB.html_for(events, raw_pages)
    parsed = PG.parse_pages(pages, url="final_url", html="html", max_links=max_links)
    return parsed.select(
        "frontier_id", "final_url", "host", "depth",
        F.struct(
            F.struct(*PG.OBSERVATION_FIELDS).alias("observation"),
            "discovered_links",
            F.struct(*PG.METADATA_FIELDS).alias("metadata"),
        ).alias("parsed"),
    )


# --- resolve stage -----------------------------------------------------------
@dataclass(frozen=True)
class Store:
    """Where the tables of the resolve stage live."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def resolve_batch(documents: DataFrame, batch_id: int, store: Store, now: Column, max_fold_rows: int = R.MAX_FOLD_ROWS) -> None:
    """Apply one batch of parsed documents: links to the frontier, observations to companies.

    Every table is published under the batch number, so a replayed batch, also
    one that failed half-way, changes each table at most once.  Companies, list
    values and links all follow from the observations of the batch and the
    companies before it, which a replay reads again: whatever a failed try has
    written, the next one gives the same ids.
    """
    spark = documents.sparkSession
    tag = f"batch-{batch_id}"
    frontier = TB.read_snapshot(spark, store.path("urls"), schemas.URLS)
    if not TB.was_published(spark, store.path("urls"), tag):
        pages = documents.select("frontier_id", "depth", F.col("parsed.discovered_links").alias("links"))
        links = FR.explode_links(pages, "links", "frontier_id", max_links=None)  # the parse stage has chosen
        _, new = FR.add_discovered_urls(frontier, links, now)
        TB.append_snapshot(new, store.path("urls"), tag)
    flat = documents.select("frontier_id", "host", "final_url", "parsed.observation.*", "parsed.metadata")
    evidence = flat.select(
        F.concat("host", F.lit("/"), F.col("frontier_id").cast("string"), F.lit(".json")).alias("evidence_object_key"),
        F.to_json(F.struct(F.struct(*PG.OBSERVATION_FIELDS).alias("observation"), "metadata")).alias("payload"),
    )
    evidence.write.mode("overwrite").parquet(f"{store.path('evidence')}/batch={batch_id}")
    # Observations are numbered after those of earlier batches, in frontier order.
    observed_root = store.path("observations")
    if not TB.was_published(spark, observed_root, tag):
        old = TB.read_snapshot(spark, observed_root, _observed_schema())
        top = F.coalesce(old.agg(F.max("id")).scalar(), F.lit(0))
        numbered = number_rows(flat, "frontier_id", ["final_url"], "_n", chunk_rows=CHUNK_DOCUMENTS)
        key = F.concat("host", F.lit("/"), F.col("frontier_id").cast("string"), F.lit(".json"))
        rows = R.observation_rows(numbered.withColumn("id", top + F.col("_n")), "final_url", key)
        shaped = rows.withColumns({"observed_at": now, "batch_id": F.lit(batch_id).cast("bigint")})
        names = _observed_schema().names
        TB.append_snapshot(shaped.select(*names), observed_root, tag)
    batch = TB.read_snapshot(spark, observed_root, _observed_schema()).where(F.col("batch_id") == batch_id).drop("batch_id")
    companies_root, links_root = store.path("companies"), store.path("company_observation_links")
    companies = TB.read_snapshot(spark, companies_root, _company_schema(), before=tag)
    if not TB.was_published(spark, links_root, tag):
        known = TB.read_snapshot(spark, links_root, _link_schema())
        done = R.resolve_observations(batch, companies, known, max_fold_rows=max_fold_rows, now=now)
        done.values.write.mode("overwrite").parquet(f"{store.path('company_values')}/batch={batch_id}")
        TB.write_snapshot(done.companies.select(*_company_schema().names), companies_root, tag)
        TB.append_snapshot(done.links.select(*_link_schema().names), links_root, tag)


def stored_values(spark: SparkSession, store: Store) -> DataFrame:
    """Social profiles and source URLs of all companies over all batches, in long form, each at its first place."""
    return SV.merged_values(spark.read.parquet(store.path("company_values")))


def _pick(schema: T.StructType, names: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([schema[n] for n in names] + list(more))


def _observed_schema() -> T.StructType:
    extra = (T.StructField("source_url", T.StringType()), T.StructField("batch_id", T.LongType()))
    return _pick(schemas.OBSERVATIONS, schemas.OBSERVATIONS.names, *extra)


def _company_schema() -> T.StructType:
    skipped = ("social_profiles", "source_urls")  # long, in company_values
    return _pick(schemas.COMPANIES, [n for n in schemas.COMPANIES.names if n not in skipped])


def _link_schema() -> T.StructType:
    return _pick(schemas.COMPANY_OBSERVATION_LINKS, ["company_id", "observation_id", "match_score", "match_reason"])


def resolve_stage(
    documents: DataFrame, store: Store, checkpoint: str, now: Callable[[], Column] = F.current_timestamp, available_now: bool = False
) -> StreamingQuery:
    """Run :func:`resolve_batch` on every micro-batch of parsed documents."""
    writer = documents.writeStream.foreachBatch(lambda df, n: resolve_batch(df, n, store, now())).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# --- stateful helpers --------------------------------------------------------
def first_arrivals(rows: DataFrame, key: str = "url_hash", event_time: str | None = None, horizon: str | None = None) -> DataFrame:
    """Insert-if-absent as a stream: the first row of every key.

    Without a horizon every key is remembered for good; with one, state is
    dropped once the watermark has passed.
    """
    if event_time and horizon:
        timed = rows.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, horizon)
        return timed.dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])


def arrivals_batch(rows: DataFrame, batch_id: int, root: str, key: str = "url_hash", buckets: int = 256) -> None:
    """Store the rows of a batch whose key no earlier batch brought, one row for each key.

    ``root`` holds them partitioned by batch and by the bucket of their key; a
    batch reads the key column of its own buckets only, of which at most
    ``buckets`` numbers reach the driver.  A batch that comes again looks at
    those before it and overwrites what it wrote.  A null key is a key.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    placed = rows.dropDuplicates([key]).withColumn("bucket", bucket)
    if batch_id > 0:
        touched = [r.bucket for r in rows.select(bucket.alias("bucket")).distinct().collect()]
        known = stored_arrivals(spark, root, rows.schema).where((F.col("batch") < batch_id) & F.col("bucket").isin(touched))
        met = known.select(F.col("bucket").alias("_bucket"), F.col(key).alias("_key"))
        placed = placed.join(met, (F.col("bucket") == F.col("_bucket")) & F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    placed.withColumn("batch", F.lit(batch_id).cast("bigint")).write.option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch", "bucket"
    ).mode("overwrite").parquet(root)


def stored_arrivals(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """First rows of all keys so far, with the batch that brought them and the bucket of the key."""
    places = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return spark.read.schema(T.StructType([*schema.fields, *places])).parquet(root)


def arrivals_stage(
    rows: DataFrame, root: str, checkpoint: str, key: str = "url_hash", buckets: int = 256, available_now: bool = False
) -> StreamingQuery:
    """Insert-if-absent over a stream whose keys never end: the memory is a table, no state grows with the keys.

    See :func:`arrivals_batch`; rows must not have columns ``batch`` or ``bucket``.
    """
    writer = rows.writeStream.foreachBatch(lambda df, n: arrivals_batch(df, n, root, key, buckets)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def live_counters(outcomes: DataFrame, by: str = "run_id") -> DataFrame:
    """Counters per run over a stream of outcomes (update or complete mode)."""
    return HL.outcome_counters(outcomes, by=by)
