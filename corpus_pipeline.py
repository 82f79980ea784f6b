"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), reads everything that its predecessor
kept, and returns a DataFrame; ``run`` writes each result as Parquet and reads
it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmloom.llm.bpe import encode_digests
from firmloom.llm.common import hinted, stored, table, text_key
from firmloom.llm.decontaminate import contaminated_words
from firmloom.llm.jaccard import one_of_each
from firmloom.llm.quality import quality_rules
from firmloom.llm.secret_scan import redact, scan

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Near duplicates share 80 of 100 shingles of five words.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, carry=tuple(docs.columns)).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return one_of_each(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    hits, _ = contaminated_words(docs, table(spark, sf_dir, "benchmark"))
    gone = hinted(stored(hits.select(F.col("id").alias("__fl_id"), F.col("_key").alias("__fl_at")).distinct()))
    keyed = docs.withColumn("__fl_key", text_key(F.col("text")))
    clean = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__fl_id"]) & (keyed["__fl_key"] == gone["__fl_at"]), "left_anti")
    return clean.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars set anew."""
    masked = redact(docs, scan(docs, VOCABULARY))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian 32-bit integers) of every document, with digests of ids and decoded text."""
    return encode_digests(docs, VOCABULARY, public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level BPE", encoding),
]
#: Training a forest and replaying merges are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
