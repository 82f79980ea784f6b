"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is kept, the last of
equal ones.  Two texts that share ``span`` words or more share such a window,
and pick the same hash in it, so no shared span of that length goes unseen.
Documents and benchmark meet on these fingerprints; around each hit the
document's words are read again and the windows of ``span`` words are compared
word by word.  Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from firmloom.llm.common import ascii_lower, hinted, let, same, stored, table, text_key

SPAN = 10
GRAM = 5
#: Everything but 0-9, a-z (A-Z before lower-casing) and code points above 7F parts words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RAW_WORD), F.lit(0))).cast("long")


def grams(words: Column, n: int) -> Column:
    """Hash of each run of n words (none if there are fewer)."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) < n, F.array().cast("array<bigint>")).otherwise(runs)


def fingerprints(words: Column, span: int = SPAN, gram: int = GRAM) -> Column:
    """array<struct<h, p>>: the winnowed hashes and their word positions, for texts of ``span`` words or more."""
    width = span - gram + 1

    def chosen(h: Column) -> Column:
        def last_smallest(i: Column) -> Column:
            window = F.slice(h, i + 1, width)
            return let(window, lambda s: i + width - F.array_position(F.reverse(s), F.array_min(s)).cast("int"))

        places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(h) - width), last_smallest))
        return F.transform(places, lambda p: F.struct(F.get(h, p).alias("h"), p.alias("p")))

    none = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.when(F.size(words) < span, none).otherwise(let(grams(words, gram), chosen))


def windows_at(words: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda s: F.struct(s.alias("s"), F.array_join(F.slice(words, s + 1, length), " ").alias("w")))


def contaminated_words(docs: DataFrame, items: DataFrame, text: str = "text", id_column: str = "doc_id", item_text: str = "text", item_id: str = "item_id", span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(hits, found): hits has id, _key, start, length of every document window that an item holds; found has id, _key and item_id.

    An item of fewer than ``span`` words counts as one window of its own length;
    winnowing can't vouch for those, so their first words are looked up at every
    position of the documents, if there are such items.  Items without words or
    id and documents without words have no hits.  ``_key`` tells apart texts
    under one id; repeated rows share their hits.
    """
    d = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).withColumn("_key", text_key(F.col("text")))
    b = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("words"))
    b = b.where(F.size("words") > 0)
    starts = F.when(F.size("words") >= span, F.sequence(F.lit(0), F.size("words") - span)).otherwise(F.array(F.lit(0)))
    length = F.least(F.size("words"), F.lit(span))
    parts = F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, length), " "))
    test = stored(b.select("item_id", length.alias("length"), F.explode(F.array_distinct(parts)).alias("w")))
    prints = stored(b.select(F.explode(fingerprints(F.col("words"), span, gram)).alias("f")).select("f.h").distinct())

    near = d.select("id", "_key", F.explode(let(words_of(F.col("text")), lambda w: fingerprints(w, span, gram))).alias("f"))
    near = stored(near.select("id", "_key", F.col("f.h").alias("h"), F.col("f.p").alias("p")).join(hinted(prints), "h", "left_semi").drop("h").distinct())
    around = near.groupBy("id", "_key").agg(F.collect_list("p").alias("ps"))
    around = hinted(stored(around), 100_000) if near.count() <= 1_000_000 else around

    def spread(words: Column) -> Column:
        reach = F.transform(F.col("ps"), lambda p: F.sequence(F.greatest(p - (span - gram), F.lit(0)), F.least(p, F.size(words) - span)))
        return windows_at(words, F.array_distinct(F.flatten(reach)), span)

    near_docs = d.join(around, same(d, around, "id", "_key")).select(d["id"], d["_key"], F.explode(let(words_of(d["text"]), spread)).alias("x"))
    whole = hinted(stored(test.where(F.col("length") == span).select("w").distinct()))
    hits = near_docs.select("id", "_key", F.col("x.s").alias("start"), F.lit(span).alias("length"), F.col("x.w").alias("w")).join(whole, "w", "left_semi")
    for (short,) in test.where(F.col("length") < span).select("length").distinct().orderBy("length").collect():  # at most span - 1 lengths
        listed = test.where(F.col("length") == short).select("w").distinct()
        keys = hinted(stored(listed.select(F.explode(grams(F.split("w", " "), short)).alias("h")).distinct()))
        at = d.select("id", "_key", F.posexplode(let(words_of(F.col("text")), lambda w: F.transform(grams(w, short), lambda h, i: F.struct(h.alias("h"), F.array_join(F.slice(w, i + 1, short), " ").alias("w"))))).alias("start", "x"))
        at = at.select("id", "_key", "start", F.lit(short).alias("length"), F.col("x.h").alias("h"), F.col("x.w").alias("w")).join(keys, "h", "left_semi")
        hits = hits.unionByName(at.drop("h").join(listed, "w", "left_semi"))
    hits = stored(hits.distinct())
    found = hits.select("id", "_key", "w").distinct().join(test, "w").select("id", "_key", "item_id").distinct()
    return hits, found


def decontamination(docs: DataFrame, items: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """Per document row: id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in any window that an item holds.  A null or empty
    text has no words and is clean; with no items every document is clean
    (items_sha256 is then that of the empty string).  Repeated rows give
    repeated results.
    """
    hits, found = contaminated_words(docs, items, text, id_column, **options)
    order = W.partitionBy("id", "_key").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    ends = hits.select("id", "_key", "start", "length").distinct().withColumn("end", F.col("start") + F.col("length"))
    fresh = ends.withColumn("done", F.coalesce(F.max("end").over(order), F.lit(0)))
    fresh = fresh.withColumn("n", F.greatest(F.lit(0), F.col("end") - F.greatest("start", "done")))
    n_hit = fresh.groupBy("id", "_key").agg(F.sum("n").alias("n_hit"))
    listed = found.groupBy("id", "_key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",").alias("items"))
    per_doc = n_hit.join(listed, same(n_hit, listed, "id", "_key")).select(n_hit["id"], n_hit["_key"], "n_hit", "n_items", "items")
    base = docs.select(F.col(id_column).alias("id"), text_key(F.col(text)).alias("_key"), word_count(F.col(text)).alias("n_words"))
    met = base.join(per_doc, same(base, per_doc, "id", "_key"), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return met.select(
        base["id"].alias(id_column), "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
