"""Near duplicates by bottom-k sketches from one hash function.

Documents with the same set of word shingles form one class.  A class keeps the
``k`` smallest hashes of its set.  Inverted lists of the kept values tell which
classes overlap; the smallest ``k`` values of two sketches together are a sample
of the union, and the share of them that both hold estimates the similarity;
pairs that may link are verified on their whole sets.

A kept value lies in both of two linked sets with a probability of at least the
asked similarity, and the values are drawn without replacement, so the number
shared is at least binomial.  The filters let through every pair above the
quantile ``TAIL`` of that distribution: a linked pair is missed with a
probability of 1 in 10^12.  Sets of up to ``k`` shingles are their own sketch,
and for them nothing is estimated.

Classes that share too few kept values with all others together drop out first;
the lists of the rest are drawn from wider sketches, which tell more apart.

Groups of many near copies don't become all their pairs: each class first meets
the most central class of each of its lists, and then only classes that aren't
connected yet.  What is found is the whole partition into connected groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from firmloom.llm.common import hashed_set, may_hold, stored, table, text_key
from firmloom.llm.jaccard import Shingler, class_of, connected
from firmloom.session import map_frames

#: Values that a sketch keeps, and that the wider sketch of a class keeps that may link at all.
K, WIDE = 96, 512
#: Bits of the bitmap of a wider sketch.
BITS = 1024
#: Probability with which the estimate may miss a linked pair.
TAIL = 1e-12
#: Most shingles that a task holds before it hands them on (8 bytes each).
HELD_SHINGLES = 2_000_000
KNOWN_CLASSES = 500_000


def fewest_shared(k: int, percent: int, tail: float = TAIL) -> int:
    """Of ``k`` values of a union, how many at least both of two linked sets hold, but for a chance of ``tail``."""
    p, below = percent / 100, 0.0
    for x in range(k + 1):
        below += math.comb(k, x) * p**x * (1 - p) ** (k - x)
        if below > tail:
            return x
    return k


def read_sketches(docs: DataFrame, words: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(id, key, n, cls) of every row of ``docs`` (id, key, text), and (cls, n, sketch) of every class."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(words), set()
        for f in frames:
            rows = []
            if len(seen) > KNOWN_CLASSES:
                seen.clear()
            for t in f["text"]:
                s = shingler(t)
                cls = class_of(s) if len(s) else 0
                new = len(s) and cls not in seen  # a copy's sketch would say the same
                rows.append((len(s), cls, s[:k].view(np.int64).tolist() if new else None))
                seen.add(cls)
            n, cls, sketch = zip(*rows, strict=True) if rows else ((), (), ())
            yield pd.DataFrame({"id": f["id"], "key": f["key"], "n": n, "cls": cls, "sketch": pd.Series(sketch, dtype="object")})

    kind = docs.schema["id"].dataType.simpleString()
    rows = stored(map_frames(docs.select("id", "key", "text"), run, f"id {kind}, key long, n long, cls long, sketch array<long>"))
    classes = rows.where("sketch IS NOT NULL").select("cls", "n", "sketch").dropDuplicates(["cls"])
    return rows.drop("sketch"), stored(classes)


def least_shared(n: Column, percent: int, k: int) -> Column:
    """Fewest values that a set of ``n`` shares with the sketch of any set it links to."""
    # up to this size a partner's sketch is whole too
    return F.when(n * 100 <= percent * k, F.ceil(n * percent / 100)).otherwise(fewest_shared(k, percent)).cast("int")


def live_classes(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """cls of the classes that share enough kept values with others, whichever these are, to link at all."""
    values = classes.select("cls", "n", F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("value")
    held = values.join(often, "value", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("live"))
    return stored(held.where(F.col("live") >= least_shared(F.col("n"), percent, k)).select("cls"))


def inverted_lists(sets: DataFrame, percent: int, k: int) -> DataFrame:
    """value, cls, comp, n, known, rest, least, central: the lists of kept values on which classes (cls, comp, shingles)
    of different components may meet.

    A class holds its values rarest first.  Two classes that link share at least
    ``least`` values, so they meet within the first values of both, and values
    that no other component holds can be left out beforehand.  ``known`` counts
    the shared values before this one, ``rest`` those from it on.
    """
    values = sets.select("cls", "comp", F.size("shingles").alias("n"), F.explode(F.slice("shingles", 1, k)).alias("value"))
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b")
    own = W.partitionBy("cls")
    held = values.join(often.select("value", "df"), "value").withColumn("known", F.row_number().over(own.orderBy("df", "value")) - 1)
    held = held.withColumn("live", F.count(F.lit(1)).over(own)).withColumn("least", least_shared(F.col("n"), percent, k))
    held = held.withColumn("central", F.avg(F.log2("df")).over(own)).where(F.col("known") <= F.col("live") - F.col("least"))
    return stored(held.select("value", "cls", "comp", "n", "known", (F.col("live") - F.col("known")).alias("rest"), "least", "central"))


def shared(rows: DataFrame, by: str) -> DataFrame:
    """The rows on lists that hold two different values of ``by`` or more."""
    ends = rows.groupBy("value").agg(F.min(by).alias("_a"), F.max(by).alias("_b")).where("_a <> _b").select("value")
    return rows.join(ends, "value", "left_semi")


PLACE = ("n", "known", "rest", "least")


def may_link(x: Column, y: Column, percent: int, k: int) -> Column:
    """Whether two classes (structs of PLACE) that meet on a value can have sizes and an overlap that link."""
    length = 100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])
    most = F.least(x["known"], y["known"]) + F.least(x["rest"], y["rest"])
    whole = (F.greatest(x["n"], y["n"]) > k) | ((100 + percent) * most >= percent * (x["n"] + y["n"]))
    return length & (most >= F.greatest(x["least"], y["least"])) & whole


def hub_pairs(rows: DataFrame, rank: Column, percent: int, k: int) -> DataFrame:
    """Each class with the first class, by ``rank``, of each of its lists."""
    hub = rows.groupBy("value").agg(F.max(F.struct(rank.alias("rank"), "cls", "comp", *PLACE)).alias("hub"))
    met = rows.join(hub, "value").where((F.col("comp") != F.col("hub.comp")) & may_link(F.struct(*PLACE), F.col("hub"), percent, k))
    return met.select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct()


def bitmaps(sets: DataFrame, k: int) -> DataFrame:
    """cls and a bitmap (BITS bits in longs) of the ``k`` smallest values of each class (cls, shingles)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for s in f["shingles"]:
                values, bits = np.asarray(s)[:k].view(np.uint64) % np.uint64(BITS), np.zeros(BITS // 64, np.uint64)
                np.bitwise_or.at(bits, (values >> np.uint64(6)).astype(np.int64), np.uint64(1) << (values & np.uint64(63)))
                rows.append(bits.view(np.int64).tolist())
            yield pd.DataFrame({"cls": f["cls"], "bits": pd.Series(rows, dtype="object")})

    return map_frames(sets.select("cls", "shingles"), run, "cls long, bits array<long>")


def cross_pairs(rows: DataFrame, bits: DataFrame, percent: int, k: int) -> DataFrame:
    """All pairs of classes of different components that meet on a list.

    The sizes are part of the join key: they lie in bands so wide that sizes
    which may link differ by one band at most.  Of two sets that fit into their
    sketches, bitmaps differ in no more places than the sets do; that tells
    pairs just below the asked similarity apart before they are formed.  A pair
    is formed on the first value that both hold and on no later one.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / (1.0001 * math.log(100 / percent))).cast("int") if percent < 100 else F.col("n").cast("int")
    earlier = W.partitionBy("cls").orderBy("known").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.collect_list("value").over(earlier)).join(bits, "cls")
    place = F.struct("cls", "comp", "bits", "before", *PLACE)
    x = rows.select("value", band.alias("band"), place.alias("x"))
    y = rows.select("value", F.explode(F.array(band - 1, band, band + 1)).alias("band"), place.alias("y"))
    apart = F.aggregate(F.zip_with("x.bits", "y.bits", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)
    both = F.col("x.n") + F.col("y.n")
    near = (F.greatest("x.n", "y.n") > k) | ((100 + percent) * apart <= (100 - percent) * both)
    met = x.join(y, ["value", "band"]).where((F.col("x.comp") < F.col("y.comp")) & may_link(F.col("x"), F.col("y"), percent, k) & near & ~F.arrays_overlap("x.before", "y.before"))
    return met.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (a, b) whose union sketch says that they may link; sets of up to ``k`` are decided for good."""
    cut = fewest_shared(k, percent)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for n, m, x, y in zip(f["n"], f["m"], f["x"], f["y"], strict=True):
                x, y = np.asarray(x).view(np.uint64), np.asarray(y).view(np.uint64)
                both = np.intersect1d(x, y, assume_unique=True)
                if n <= k and m <= k:
                    keep.append(100 * len(both) >= percent * (n + m - len(both)))
                else:
                    keep.append(np.searchsorted(both, np.union1d(x, y)[k - 1], "right") >= cut)
            yield f.loc[keep, ["a", "b"]]

    a, b = (classes.select(F.col("cls").alias(c), F.col("n").alias(n), F.col("sketch").alias(s)) for c, n, s in (("a", "n", "x"), ("b", "m", "y")))
    return stored(map_frames(pairs.join(a, "a").join(b, "b").select("a", "b", "n", "m", "x", "y"), run, "a long, b long"))


def read_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls and shingles (sorted hashes) of the wanted classes; texts are read again and not shuffled.

    Which text stands for a class goes to the tasks as a bitmap of text hashes,
    of fixed size; it may let through a few other texts, which no pair asks for.
    """
    texts = rows.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("key").alias("key"))
    bitmap = docs.sparkSession.sparkContext.broadcast(hashed_set(texts.select("key")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(words), set()
        for f in frames:
            sets, held = {}, 0
            if len(seen) > KNOWN_CLASSES:
                seen.clear()
            for key, t in f.loc[may_hold(bitmap.value, f["key"].to_numpy()), ["key", "text"]].itertuples(index=False):
                if key in seen:
                    continue
                seen.add(key)
                s = shingler(t)
                sets[class_of(s)] = s.view(np.int64)
                held += len(s)
                if held > HELD_SHINGLES:
                    yield pd.DataFrame({"cls": list(sets), "shingles": list(sets.values())})
                    sets, held = {}, 0
            yield pd.DataFrame({"cls": pd.Series(list(sets), dtype="int64"), "shingles": pd.Series(list(sets.values()), dtype="object")})

    return stored(map_frames(docs.select("key", "text"), run, "cls long, shingles array<long>").dropDuplicates(["cls"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for x, y in zip(f["x"], f["y"], strict=True):
                x, y = np.asarray(x).view(np.uint64), np.asarray(y).view(np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield f.loc[keep, ["a", "b"]]

    a, b = (sets.select(F.col("cls").alias(c), F.col("shingles").alias(s)) for c, s in zip("ab", "xy", strict=True))
    return stored(map_frames(pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y"), run, "a long, b long"))


def components(rows: DataFrame, edges: DataFrame | None) -> DataFrame:
    """``rows`` with ``comp``, the class that names the component of ``cls``."""
    if edges is None:
        return rows.withColumn("comp", F.col("cls"))
    found = connected(edges)
    return rows.join(found, rows["cls"] == found["node"], "left").select(*rows.columns, F.coalesce("comp", "cls").alias("comp"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, n_shingles, component_id (smallest linked id), kept (id = component_id) and _key (hash of the text) of every row.

    A set holds the distinct shingles of ``words`` words (A-Z lower-cased, parted
    by ASCII white space); a text with fewer has one, all its words.  Rows link
    when 100 * intersection >= percent * union.  Null, empty and blank texts have
    no shingles, link with nothing and are kept.  Long texts count whole.  Equal
    rows share a component; rows of one id but different texts are judged by
    their texts, and all rows of a kept id say so.  Null ids count only where a
    component has no other.  An empty table gives an empty one.  Other columns,
    whatever their names, play no part and don't come out.
    """
    d = docs.select(F.col(id_column).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    rows, classes = read_sketches(d, words, k)
    live = live_classes(classes, percent, k)
    own = stored(classes.join(live, "cls", "left_semi"))
    sets = read_sets(d, rows, live, words)
    edges, lists = None, inverted_lists(sets.withColumn("comp", F.col("cls")), percent, WIDE)
    for turn in range(3):
        open_rows = stored(shared(components(lists.drop("comp"), edges), "comp"))
        if open_rows.isEmpty():
            break
        if turn < 2:
            pairs = hub_pairs(open_rows, F.col("central") if turn == 0 else F.xxhash64("cls", "value").cast("double"), percent, WIDE)
        else:  # draw the lists anew: values that only one component holds say nothing any more
            left = sets.join(open_rows.select("cls").distinct(), "cls", "left_semi")
            anew = inverted_lists(components(left, edges), percent, WIDE)
            pairs = cross_pairs(anew, stored(bitmaps(left, WIDE)), percent, WIDE)
        more = verified(estimated(pairs, own, percent, k), sets, percent)
        edges = more if edges is None else edges.union(more)
    grouped = components(rows, edges)
    smallest = grouped.where("n > 0").groupBy("comp").agg(F.min("id").alias("least")).withColumnRenamed("comp", "of")
    met = grouped.join(smallest, (F.col("n") > 0) & (F.col("comp") == F.col("of")), "left")
    found = met.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"), F.col("key").alias("_key"))
    return found.select(id_column, "n_shingles", "component_id", F.col(id_column).eqNullSafe(F.col("component_id")).alias("kept"), "_key")


def op11_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("_key")
