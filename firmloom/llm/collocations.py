"""Phrase collocations by prefix-free parsing.

Every run of words between punctuation is cut into chunks: a window of
``OVERLAP`` words whose hash falls on a trigger ends one chunk and begins the
next, so both hold it.  Where equal passages occur, equal chunks come out, and
the corpus becomes a dictionary of distinct chunks with their parse frequencies.
N-grams are counted inside each distinct chunk once, weighted by its frequency.
An n-gram of up to ``OVERLAP + 1`` words that lies in the overlap of two chunks
is counted in the second one only: a chunk counts what starts before its last
``OVERLAP`` words, the last chunk of a run counts all.

Counts are exact.  Pairs are looked for only where both words are frequent, and
phrases only where all their pairs are; tasks learn which are from bitmaps of
fixed size that never deny a frequent one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from firmloom.llm.common import LOWER, UPPER, hashed_set, may_hold, stored, table
from firmloom.session import map_frames, ship_package
from firmloom.skew import lookup_join

#: Words that two chunks share: one fewer than the longest phrase has.
OVERLAP = 3
LONGEST = OVERLAP + 1
#: One window in so many is a trigger.
TRIGGER = 16
#: Words of the dictionary that a task counts at once, and chunks or words that it gathers before it hands them on.
COUNTED_WORDS, GATHERED = 3_000_000, 200_000
NO_LANGUAGE = "und"
#: Bytes as they count: A-Z lower-cased, every end of a piece a line end.  UTF-8 keeps other code points apart from these bytes.
BYTES = bytes.maketrans(UPPER.encode() + b".,;:!?\x0b\x0c\r", LOWER.encode() + b"\n" * 9)
#: Lookups of a phrase part that are still dealt out by the part.
HOT_PARTS = 20_000
SALTS = 32


INNER, LAST, SINGLE = 0, 1, 2
FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


class Hashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word)
        return value


class Parser:
    """Cuts texts into chunks."""

    def __init__(self):
        self.known = Hashes()

    def __call__(self, text: str) -> tuple[list[bytes], list[tuple[bytes, int]]]:
        """All words of a text, and its chunks, each INNER or the LAST of its piece."""
        pieces = [w for w in map(bytes.split, text.encode().translate(BYTES).split(b"\n")) if w]
        words = list(chain.from_iterable(pieces))
        if len(self.known) > GATHERED:
            self.known.clear()
        cut = np.empty(0, np.int64)
        if len(words) > LONGEST:
            h = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            window = sum(h[k : len(h) - OVERLAP + 1 + k] * (2 * k + 1) for k in range(OVERLAP))
            cut = np.flatnonzero(window % 1_000_003 % TRIGGER == 0)
        found, at, place, cuts = [], 0, 0, [*cut.tolist(), len(words)]
        for piece in pieces:
            begin, end = at, at + len(piece)
            while cuts[place] <= begin:
                place += 1
            while cuts[place] < end - OVERLAP:
                found.append((b" ".join(words[begin : cuts[place] + OVERLAP]), INNER))
                begin = cuts[place]
                place += 1
            found.append((b" ".join(words[begin:end] if begin > at else piece), LAST))
            at = end
        return words, found


def parse(docs: DataFrame) -> DataFrame:
    """lang, chunk, kind and how often it occurs: distinct chunks (INNER or LAST) and words (SINGLE) of ``docs`` (lang, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser, found, singles = Parser(), Counter(), {}

        def out(rows) -> pd.DataFrame:
            return pd.DataFrame([(lang, c.decode(), kind, n) for lang, c, kind, n in rows], columns=["lang", "chunk", "kind", "times"], dtype="object")

        def parted() -> pd.DataFrame:
            frame = out((*key, n) for key, n in found.items())
            found.clear()
            return frame

        def single() -> pd.DataFrame:
            frame = out((lang, w, SINGLE, n) for lang, counts in singles.items() for w, n in counts.items())
            singles.clear()
            return frame

        for f in frames:
            for lang, text in zip(f["lang"], f["text"], strict=True):
                if text:
                    words, parts = parser(text)
                    singles.setdefault(lang, Counter()).update(words)
                    found.update((lang, c, kind) for c, kind in parts)
                    if len(found) > GATHERED:
                        yield parted()
                    if sum(map(len, singles.values())) > GATHERED:
                        yield single()
        yield parted()
        yield single()

    made = map_frames(docs, run, "lang string, chunk string, kind int, times long")
    return stored(made.groupBy("lang", "chunk", "kind").agg(F.sum("times").alias("times")))


class Places:
    """The word places of a batch of chunks (lang, chunk, kind, times)."""

    def __init__(self, batch: pa.Table):
        split = pc.split_pattern(batch["chunk"].combine_chunks(), " ")
        size = np.diff(split.offsets.to_numpy())
        words = split.flatten().dictionary_encode()
        langs = batch["lang"].combine_chunks().dictionary_encode()
        self.code, self.names = words.indices.to_numpy().astype(np.int64), words.dictionary
        self.lang, self.lang_names = np.repeat(langs.indices.to_numpy().astype(np.int64), size), langs.dictionary
        self.room = np.repeat(np.cumsum(size), size) - np.arange(len(self.code))  # words from here to the chunk's end
        self.weight = np.repeat(batch["times"].to_numpy(), size)
        self.counts = np.repeat(batch["kind"].to_numpy() == LAST, size) | (self.room > OVERLAP)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of a place's word, and of it and the next one, with the language."""
        seeds, own = (pd.util.hash_array(np.array(x.to_pylist(), dtype=object), categorize=False) for x in (self.lang_names, self.names))
        one = (own[self.code] ^ seeds[self.lang] * FACTORS[0]) * FACTORS[1]
        one ^= one >> np.uint64(31)
        return one, ((one + np.roll(own[self.code], -1)) ^ one >> np.uint64(7)) * FACTORS[0]

    def at(self, n: int, able: np.ndarray) -> np.ndarray:
        """Places where an n-gram counts and all its pairs of words are able."""
        every = able
        for k in range(1, n - 1):
            every = every & np.roll(able, -k)
        return np.flatnonzero(every & self.counts & (self.room >= n))

    def grams(self, n: int, at: np.ndarray) -> pa.Table:
        """The distinct n-grams at the places ``at`` and their summed weights."""
        number = self.lang[at]
        for k in range(n):  # dense numbers of ever longer n-grams: exact, no hashes
            number, distinct = pd.factorize(number * len(self.names) + self.code[at + k])
        first = np.empty(len(distinct), np.int64)
        first[number[::-1]] = np.arange(len(at))[::-1]
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, number, self.weight[at])
        place = at[first]
        phrase = pc.binary_join_element_wise(*[self.names.take(pa.array(self.code[place + k])) for k in range(n)], " ")
        return pa.table({"lang": self.lang_names.take(pa.array(self.lang[place])), "phrase": phrase, "f": sums})


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[Places]:
    """Places of some COUNTED_WORDS words at a time."""
    gathered, held = [], 0
    for b in batches:
        gathered.append(b)
        held += b["chunk"].nbytes // 6
        if held > COUNTED_WORDS:
            yield Places(pa.Table.from_batches(gathered))
            gathered, held = [], 0
    if gathered and sum(map(len, gathered)):
        yield Places(pa.Table.from_batches(gathered))


def word_hashes(words: DataFrame) -> DataFrame:
    """The hash of every word (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                none = np.zeros(len(b), np.int64)
                yield from pa.table({"h": Places(pa.table({"lang": b["lang"], "chunk": b["phrase"], "kind": none, "times": none})).hashes()[0].view(np.int64)}).to_batches()

    return map_batches(words.select("lang", "phrase"), run, "h long")


def able_pairs(chunks: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Hashes of the pairs of words that may have ``least`` occurrences or more: every such pair, and those that share its hash."""
    bitmap = chunks.sparkSession.sparkContext.broadcast(hashed_set(word_hashes(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _batched(batches):
            one, two = places.hashes()
            able = may_hold(bitmap.value, one)
            at = places.at(2, able & np.roll(able, -1))
            number, distinct = pd.factorize(two[at])
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, number, places.weight[at])
            yield from pa.table({"h": distinct.view(np.int64), "f": sums}).to_batches()

    made = map_batches(chunks, run, "h long, f long")
    return made.groupBy("h").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("h")


def longer_phrases(chunks: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """lang, phrase, f, words of the phrases of 2 to LONGEST words with ``least`` occurrences or more, from the frequent words."""
    bitmap = chunks.sparkSession.sparkContext.broadcast(hashed_set(able_pairs(chunks, words, least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _batched(batches):
            able = may_hold(bitmap.value, places.hashes()[1])
            for n in range(2, LONGEST + 1):
                at = places.at(n, able)
                if len(at):
                    yield from places.grams(n, at).to_batches()

    made = map_batches(chunks, run, "lang string, phrase string, f long")
    frequent = made.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return frequent.withColumn("words", F.size(F.split("phrase", " ")))


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def phrase_counts(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, words) of all n-grams of up to LONGEST words with ``least`` occurrences or more in ``docs``
    (lang, text), and (lang, n) with the number of words."""
    parsed = parse(docs)
    singles = parsed.where(F.col("kind") == SINGLE)
    totals = singles.groupBy("lang").agg(F.sum("times").alias("n"))
    chunks = parsed.where(F.col("kind") != SINGLE)
    frequent = stored(singles.where(F.col("times") >= least).select("lang", F.col("chunk").alias("phrase"), F.col("times").alias("f"), F.lit(1).alias("words")))
    every = frequent.unionByName(longer_phrases(chunks, frequent, least))
    return stored(every), totals


def collocations(
    docs: DataFrame, least: int = 30, cover_percent: int = 80, scale: int = 2_000_000, top: int = 2000, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    Pieces end at ``. , ; : ! ?`` and line ends, words at spaces and tabs; A-Z
    are lower-cased.  Phrases of 2 to 4 words with ``least`` occurrences or more
    (``a``) count; the cut of a phrase into two parts (``l`` and ``r``
    occurrences) with the lowest score ``scale * a // (l + r)`` decides, ties to
    the shortest first part.  Phrases inside a longer one that has
    ``cover_percent`` of their occurrences are left out.

    A null language is ``und``; null and empty texts hold no words; long texts
    count whole; repeated rows count each time.  An empty table gives an empty
    one.  Other columns play no part, whatever their names.
    """
    every, totals = phrase_counts(docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text")), least)

    def keyed(phrase):  # a phrase holds no tab
        return F.concat(phrase, F.lit("\t"), F.col("lang"))

    def part(first, count):
        return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")

    found = every.where("words > 1").withColumnRenamed("f", "a")
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", keyed(part(F.lit(1), F.col("cut")))).withColumn("right", keyed(part(F.col("cut") + 1, F.col("words"))))
    known = every.select(keyed(F.col("phrase")).alias("key"), "f")
    spread = F.concat("phrase", F.lit("\t"), "lang", F.lit("\t"), "cut")
    cuts = stored(lookup_join(stored(cuts), known.select(F.col("key").alias("left"), F.col("f").alias("l")), "left", spread, HOT_PARTS))
    cuts = lookup_join(cuts, known.select(F.col("key").alias("right"), F.col("f").alias("r")), "right", spread, HOT_PARTS)
    exact = [F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")]
    scored = cuts.withColumn("a_", exact[0] * scale).withColumn("lr", exact[1] + exact[2]).withColumn("score", F.expr("a_ div lr").cast("long"))
    least_cut = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("by"))
    longer = found.where("words > 2").select("lang", F.col("a").alias("f"), "words", "phrase", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inside = longer.select("lang", "f", F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1), lambda i: part(i, F.col("size")))).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = least_cut.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * cover_percent)
    )
    rows = kept.select("lang", "phrase", "a", F.col("by.l").alias("l"), F.col("by.r").alias("r"), F.col("by.score").alias("score"))
    salted = _first(rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), ["lang", "_salt"], top).drop("rank", "_salt")
    ranked = _first(salted, ["lang"], top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
