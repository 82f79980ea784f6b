"""N-gram Jaccard join with rare-first prefixes.

Documents with the same set of word shingles form one class; only classes are
compared.  The shingles of a class are put in one global order, rare ones
first; of that order a class enters a prefix long enough that two classes as
alike as asked share ``extra`` entries there or more.  Classes with too few
shared entries drop out, the others meet on the entries of the plain prefix
under length, positional and suffix filters, and every pair is verified once
on the whole sets.

Groups of many near copies don't become all their pairs: each class first meets
the most central class of each entry, and then only pairs that aren't already
connected.  What is found is the full partition into connected groups.

Frequencies come from a sketch of fixed size that counts every shingle of every
document.  It decides the order only: whatever the order, no link is lost.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from firmloom.llm.common import discard, hinted, same, stored, table, text_key
from firmloom.session import map_frames

#: Buckets of the frequency sketch (4 bytes each where it is used): its size never grows with the data.
SKETCH_BITS = 20
CHUNKS = 16
#: Parts of the hash range in which the suffix filter counts.
PARTS = 64
KNOWN_WORDS = 200_000
PLACE = ("n", "pos", "known")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z are lower-cased, ASCII white space parts words."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode().lower().split()
        if not tokens:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(tokens):
            if w not in known:
                known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        h = np.fromiter((known[w] for w in tokens), np.uint64, len(tokens))
        size = min(self.words, len(h))
        with np.errstate(over="ignore"):
            total = np.full(len(h) - size + 1, size, np.uint64)
            for k in range(size):
                total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
        return np.unique(total)


def class_of(shingles: np.ndarray) -> int:
    """64-bit name of a set of shingles."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(n: int | np.ndarray, percent: int):
    """Shingles that a set of n must share with any set it links to."""
    return -(-percent * n // 100)


def extra(n: int) -> int:
    """Shared prefix entries, beyond the plain prefix, that the longer prefix guarantees."""
    return -(-n // 20)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def read_classes(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """(id, key, n, cls) of every row of ``docs`` (id, key, text), and the sketch of how many documents hold a shingle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, counts = Shingler(words), np.zeros(1 << SKETCH_BITS, np.int64)
        for f in frames:
            sets = [shingler(t) for t in f["text"]]
            for s in sets:
                np.add.at(counts, _bucket(s), 1)
            n = [len(s) for s in sets]
            yield pd.DataFrame({"id": f["id"], "key": f["key"], "n": n, "cls": [class_of(s) if len(s) else 0 for s in sets], "chunk": -1, "part": None})
        for c, part in enumerate(np.split(counts, CHUNKS)):
            if part.any():
                yield pd.DataFrame({"id": [None], "key": 0, "n": 0, "cls": 0, "chunk": c, "part": [zlib.compress(part.astype("<u4").tobytes(), 1)]}).astype({"id": "object"})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for f in frames:
            for c, part in zip(f["chunk"], f["part"], strict=True):
                more = np.frombuffer(zlib.decompress(part), "<u4").astype(np.int64)
                sums[c] = sums[c] + more if c in sums else more
        for c, s in sums.items():
            yield pd.DataFrame({"chunk": [c], "part": [s.tobytes()]})

    kind = docs.schema["id"].dataType.simpleString()
    rows = stored(map_frames(docs.select("id", "key", "text"), run, f"id {kind}, key long, n long, cls long, chunk int, part binary"))
    parts = map_frames(rows.where("chunk >= 0").select("chunk", "part").repartition(CHUNKS, "chunk"), add, "chunk int, part binary")
    sketch = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.int64)
    for c, part in parts.collect():  # CHUNKS rows, 8 MB in all
        sketch[c] = np.frombuffer(part, np.int64)
    return rows.where("chunk = -1").select("id", "key", "n", "cls"), np.minimum(sketch.reshape(-1), 2**32 - 1).astype(np.uint32)


def read_prefixes(docs: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """One row per class: cls, no (a number), n, central (mean log-frequency), parts (suffix filter counts), prefix (rare-first hashes)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch)  # of fixed size

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, frequency, seen = Shingler(words), shared.value, set()
        for f in frames:
            rows = []
            if len(seen) > KNOWN_WORDS:
                seen.clear()
            for t in f["text"]:
                s = shingler(t)
                cls = class_of(s)
                if not len(s) or cls in seen:  # a copy's row would say the same
                    continue
                seen.add(cls)
                often = frequency[_bucket(s)]
                first = s[np.lexsort((s, often))][: len(s) - needed(len(s), percent) + extra(len(s))]
                parts = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=PARTS)
                rows.append((cls, len(s), float(np.log2(often.astype(float) + 1).mean()), parts.tolist(), first.view(np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["cls", "n", "central", "parts", "prefix"])

    made = map_frames(docs.select("text"), run, "cls long, n long, central double, parts array<int>, prefix array<long>")
    return stored(made.dropDuplicates(["cls"]).withColumn("no", F.monotonically_increasing_id()))  # numbers hold once they are written


def _shared(rows: DataFrame, by: str) -> DataFrame:
    """The rows on entries that hold two different values of ``by`` or more."""
    ends = rows.groupBy("token").agg(F.min(by).alias("_a"), F.max(by).alias("_b")).where("_a <> _b").select("token")
    return rows.join(ends, "token", "left_semi")


def entries(classes: DataFrame, percent: int) -> DataFrame:
    """token, cls, n, pos, known, central for the classes that share enough of their longer prefix, within the plain prefix.

    ``known`` counts the class's entries before this one that others hold too:
    of all that stands before, only those can be common.  Entries too far down
    for what is left to be enough are dropped.
    """
    # half of a hash tells entries apart well enough for a count: two that fall together only keep more
    every = classes.select("no", F.explode(F.transform("prefix", lambda x: F.shiftright(x, 32).cast("int"))).alias("half"))
    several = every.groupBy("half").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("half")
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    counts = every.join(several, "half", "left_semi").groupBy("no").agg(F.count(F.lit(1)).alias("_n"))
    live = classes.join(counts, "no").where(F.col("_n") >= F.ceil(least / 20))  # a partner may be smaller, and so guarantee less
    plain = F.slice("prefix", F.lit(1), (F.col("n") - least + 1).cast("int"))
    all_rows = stored(live.select("cls", "n", "central", F.posexplode(plain).alias("pos", "token")))
    known = _shared(all_rows, "cls").withColumn("known", F.row_number().over(W.partitionBy("cls").orderBy("pos")) - 1)
    able = stored(known.where(F.col("known") + F.col("n") - F.col("pos") >= least))
    kept = stored(_shared(able, "cls"))
    discard(all_rows, able)
    return kept


def may_link(x: Sequence[Column], y: Sequence[Column], percent: int) -> Column:
    """Length filter, and the positional filter for an entry of two classes (n, pos and known of each)."""
    (n1, p1, k1), (n2, p2, k2) = x, y
    length = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    most = F.least(k1, k2) + F.least(n1 - p1, n2 - p2)
    return length & ((100 + percent) * most >= percent * (n1 + n2))


def read_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls and shingles (sorted hashes as bytes) of the wanted classes, from one document each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for f in frames:
            sets = [shingler(t) for t in f["text"]]
            yield pd.DataFrame({"cls": [class_of(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    ids = stored(rows.where("n > 0").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("id").alias("id")).select("id"))
    found = docs.join(hinted(ids), same(docs, ids, "id"), "left_semi").select("text")
    sets = stored(map_frames(found, run, "cls long, shingles binary").dropDuplicates(["cls"]))
    discard(ids)
    return sets


def verified(pairs: DataFrame, info: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link: suffix filter on the part counts, then the whole sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = []
            for x, y in zip(f["x"], f["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield f.loc[keep, ["a", "b"]]

    left, right = (info.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("parts").alias(f"parts_{c}")) for c in "ab")
    most = F.aggregate(F.zip_with("parts_a", "parts_b", lambda p, q: F.least(p, q)), F.lit(0), lambda s, p: s + p)
    near = pairs.join(left, "a").join(right, "b").where((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    x, y = (sets.select(F.col("cls").alias(c), F.col("shingles").alias(s)) for c, s in zip("ab", "xy", strict=True))
    return stored(map_frames(near.join(x, "a").join(y, "b").select("a", "b", "x", "y"), run, "a long, b long"))


def connected(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node of its component, for every node of ``edges`` (a, b).

    Each round hangs every node on its smallest neighbour and goes on with the
    edges between what is left; the number of rounds grows with the logarithm
    of the component's size.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("comp", F.col("node"))
    spent = [edges]
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("at"), F.least("a", "b").alias("up")))
        labels = labels.join(up, F.col("comp") == F.col("at"), "left").select("node", F.coalesce("up", "comp").alias("comp"))
        moved = edges.join(up, F.col("a") == F.col("at")).select(F.col("up").alias("a"), "b")
        moved = moved.join(up, F.col("b") == F.col("at")).select("a", F.col("up").alias("b"))
        edges = stored(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        spent += [up, edges]
    found = stored(labels)
    discard(*spent)
    return found


def _components(rows: DataFrame, edges: DataFrame | None) -> DataFrame:
    """``rows`` with ``comp``, the class that names the component of ``cls``."""
    if edges is None:
        return rows.withColumn("comp", F.col("cls"))
    found = connected(edges)
    return rows.join(found, rows["cls"] == found["node"], "left").select(*rows.columns, F.coalesce("comp", "cls").alias("comp"))


def star_pairs(rows: DataFrame, rank: Column, percent: int) -> DataFrame:
    """Each class with the first class, by ``rank``, of each of its entries."""
    hub = rows.groupBy("token").agg(F.max(F.struct(rank.alias("rank"), "cls", "n", "pos", "known", "comp")).alias("hub"))
    met = rows.join(hub, "token").where((F.col("comp") != F.col("hub.comp")) & may_link([F.col(c) for c in PLACE], [F.col(f"hub.{c}") for c in PLACE], percent))
    return met.select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct()


def cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes of different components that share an entry; pairs inside a component are never formed.

    The length filter is part of the join key: sizes lie in bands so wide that
    sizes which may link differ by one band at most.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / (1.0001 * math.log(100 / percent))).cast("int") if percent < 100 else F.col("n").cast("int")
    banded = rows.withColumn("band", band)
    best = [F.max("known").alias("k"), F.max(F.col("n") - F.col("pos")).alias("r"), F.min("n").alias("lo"), F.max("n").alias("hi")]
    places = banded.groupBy("token", "band", "comp").agg(*best).select("token", "band", "comp", F.struct("k", "r", "lo", "hi").alias("p"))
    reach = places.select("token", F.col("band").alias("yb"), F.col("comp").alias("cb"), F.col("p").alias("q"), F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"))
    length = 100 * F.least("p.hi", "q.hi") >= percent * F.greatest("p.lo", "q.lo")
    most = F.least("p.k", "q.k") + F.least("p.r", "q.r")
    able = length & ((100 + percent) * most >= percent * (F.col("p.lo") + F.col("q.lo")))  # what the best of both could do
    meet = places.join(reach, ["token", "band"]).where((F.col("comp") < F.col("cb")) & able).select("token", F.col("band").alias("xb"), F.col("comp").alias("ca"), "yb", "cb", "q")
    x, y = (
        banded.select("token", F.col("band").alias(f"{s}b"), F.col("comp").alias(c), F.col("cls").alias(s), F.struct(*PLACE).alias(f"at_{s}"))
        for s, c in (("x", "ca"), ("y", "cb"))
    )
    one_able = (100 * F.least("at_x.n", "q.hi") >= percent * F.greatest("at_x.n", "q.lo")) & (
        (100 + percent) * (F.least("at_x.known", "q.k") + F.least(F.col("at_x.n") - F.col("at_x.pos"), F.col("q.r"))) >= percent * (F.col("at_x.n") + F.col("q.lo"))
    )
    met = meet.join(x, ["token", "xb", "ca"]).where(one_able).join(y, ["token", "yb", "cb"]).where(may_link(*[[F.col(f"at_{s}.{c}") for c in PLACE] for s in "xy"], percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, n_shingles, component_id (smallest linked id) and _key (hash of the text) of every row of ``docs``.

    A set holds the distinct shingles of ``words`` words; a text with fewer has
    one, all its words.  Rows link when 100 * intersection >= percent * union.
    Null, empty and blank texts have no shingles and link with nothing.  Rows
    with one id but different texts are judged by their texts; null ids count
    only where a component has no other.
    """
    d = docs.select(F.col(id_column).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    rows, sketch = read_classes(d, words)
    classes = read_prefixes(d, sketch, words, percent)
    live = entries(classes, percent)
    sets = read_sets(d, rows, live.select("cls").distinct(), words)
    info = stored(classes.join(live.select("cls").distinct(), "cls", "left_semi").select("cls", "n", "parts"))
    discard(classes)
    edges = None
    for turn in range(3):
        open_rows = stored(_shared(_components(live, edges), "comp"))
        if open_rows.isEmpty():
            discard(open_rows)
            break
        if turn < 2:
            pairs = star_pairs(open_rows, F.col("central") if turn == 0 else F.xxhash64("cls", "token").cast("double"), percent)
        else:
            pairs = cross_pairs(open_rows, percent)
        pairs = stored(pairs)
        more = verified(pairs, info, sets, percent)
        edges = more if edges is None else edges.union(more)
        discard(open_rows, pairs)
    discard(live, sets, info)
    grouped = _components(rows, edges)
    smallest = grouped.where("n > 0").groupBy("comp").agg(F.min("id").alias("least")).withColumnRenamed("comp", "of")
    met = grouped.join(smallest, (F.col("n") > 0) & (F.col("comp") == F.col("of")), "left")
    return met.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"), F.col("key").alias("_key"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each connected group: the one with the smallest id.

    Of repeated rows with one id and text a single one stays.
    """
    rows = stored(near_duplicates(docs, words, percent, text, id_column))
    per_row = rows.groupBy(F.col(id_column).alias("__fl_id"), "_key").agg(F.max(~F.col(id_column).eqNullSafe(F.col("component_id"))).alias("__fl_gone"), F.count(F.lit(1)).alias("__fl_n"))
    odd = hinted(stored(per_row.where("__fl_gone OR __fl_n > 1").withColumnRenamed("_key", "__fl_at")))
    keyed = docs.withColumn("__fl_key", text_key(F.col(text)))
    met = keyed.join(odd, keyed[id_column].eqNullSafe(odd["__fl_id"]) & (keyed["__fl_key"] == odd["__fl_at"]), "left").where("__fl_gone IS NULL OR NOT __fl_gone")
    single = met.where("__fl_n IS NULL").select(*docs.columns)
    repeated = met.where("__fl_n IS NOT NULL").dropDuplicates([id_column, "__fl_key"]).select(*docs.columns)
    return single.unionByName(repeated)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90).drop("_key")
