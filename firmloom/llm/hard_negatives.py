"""Hard negatives of anchors, scored the Four-Russians way.

Components are scaled to integers.  A row's bits are packed by plane: for each
group of eight dimensions one byte holds the same bit of its eight components.
For an anchor and a group, a table holds the sum of the anchor's components over
each of the 256 subsets, so that the score of a row is a sum of looked-up table
entries, shifted by plane (the sign plane counts negative).  Scores are exact
integers; no score is estimated and no row is left out.

Anchors come in blocks of bounded size.  A block travels to the tasks, each task
scores its own rows and keeps the best few per anchor, and only these are
shuffled.  The rows are never shuffled, however many blocks there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from firmloom.llm.common import stored, table
from firmloom.session import map_frames

#: Anchors in a block, on average: what goes to the driver and the tasks at once.  For 64 dimensions
#: that is 2 MB, and tables of 64 MB in a task.
ANCHORS = 4096
#: Rows that a task scores at once, and anchors that it scores them against at once.
ROWS, TABLES = 2048, 256
SCALE = 256
#: Rows with a squared length of 2^61 or more take no part: a score could pass 64 bits.
MAX_SQUARE = float(1 << 61)


def scaled(vector: Column) -> Column:
    """floor(256 * x) of every component, as 64-bit integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit ``d`` of a byte is the plane's bit of the group's dimension ``d``."""
    n, dims = values.shape
    wide = np.zeros((n, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = values
    bits = (wide[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of an anchor's components over every subset of a group."""
    n, dims = anchors.shape
    wide = np.zeros((n, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = anchors
    parts = wide.reshape(n, -1, 8).transpose(1, 2, 0)
    sums = np.zeros((parts.shape[0], 256, n), np.int64)
    for d in range(8):
        sums[:, 1 << d : 2 << d] = sums[:, : 1 << d] + parts[:, d : d + 1]
    return sums


def scores(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact scores from packed rows and subset sums."""
    n, planes, groups = packed.shape
    total = np.zeros((n, sums.shape[2]), np.int64)
    for p in reversed(range(planes)):  # shift and add, highest plane first
        part = np.zeros_like(total)
        for g in range(min(groups, len(sums))):
            part += sums[g][packed[:, p, g]]
        total = (total << 1) + part if p < planes - 1 else -part
    return total


class Best:
    """The first ``k`` rows of every column by (score descending, id, row), over any number of blocks."""

    def __init__(self, columns: int, k: int):
        self.k, self.least = k, np.full(columns, np.iinfo(np.int64).min)
        self.held = np.empty((0, 4), np.int64)  # column, score, id, row

    def add(self, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, rows: np.ndarray, first_column: int) -> None:
        span = slice(first_column, first_column + score.shape[1])
        hits = allowed & (score >= self.least[span])
        if hits.sum() > 8 * self.k * score.shape[1] and len(score) > self.k:
            kth = np.partition(np.where(hits, score, np.iinfo(np.int64).min), len(score) - self.k, axis=0)[len(score) - self.k]
            hits &= score >= kth
        at, column = np.nonzero(hits)
        if not len(at):
            return
        held = np.concatenate([self.held, np.stack([column + first_column, score[at, column], ids[at], rows[at]], 1)])
        held = held[np.lexsort((held[:, 3], held[:, 2], ~held[:, 1], held[:, 0]))]
        starts = np.flatnonzero(np.r_[True, held[1:, 0] != held[:-1, 0]])
        rank = np.arange(len(held)) - np.repeat(starts, np.diff(np.r_[starts, len(held)]))
        self.held = held[rank < self.k]
        full = self.held[np.flatnonzero(rank[rank < self.k] == self.k - 1)]
        self.least[full[:, 0]] = full[:, 1]


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def packed_rows(rows: DataFrame, planes: int, dims: int) -> DataFrame:
    """row, id, label and the packed planes of every row (row, id, label, v)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for start in range(0, len(f), ROWS):
                part = f.iloc[start : start + ROWS]
                packed = pack(_matrix(part["v"], dims), planes)
                yield pd.DataFrame({"row": part["row"], "id": part["id"], "label": part["label"], "planes": [x.tobytes() for x in packed]})

    return stored(map_frames(rows, run, "row long, id long, label long, planes binary"))


class Block:
    """A block of anchors, as a task sees it: labels, rows and tables of subset sums."""

    def __init__(self, anchors: pd.DataFrame, dims: int, planes: int):
        self.values, self.labels, self.rows = _matrix(anchors["v"], dims), anchors["label"].to_numpy(), anchors["row"].to_numpy()
        self.tables = [(s, subset_sums(self.values[s : s + TABLES])) for s in range(0, len(anchors), TABLES)]
        self.shape = (-1, planes, -(-dims // 8))

    def scored(self, frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """(ids, rows, labels, slice of the anchors, scores) for every part of the rows and of the anchors."""
        for f in frames:
            for start in range(0, len(f), ROWS):
                part = f.iloc[start : start + ROWS]
                packed = np.frombuffer(b"".join(part["planes"]), np.uint8).reshape(self.shape)
                ids, rows, labels = (part[c].to_numpy() for c in ("id", "row", "label"))
                for s, sums in self.tables:
                    yield ids, rows, labels, slice(s, s + sums.shape[2]), scores(packed, sums)


def _merged(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of every group from the first ``k`` of every task; ``rank`` from 1."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def first_of_label(rows: DataFrame, anchors: pd.DataFrame, dims: int, planes: int, k: int) -> DataFrame:
    """anchor, score, id, row, rank: the first ``k`` other rows of each anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(shared.value, dims, planes)
        best = Best(len(block.rows), k)
        for ids, at, labels, span, score in block.scored(frames):
            best.add(score, (labels[:, None] == block.labels[span]) & (at[:, None] != block.rows[span]), ids, at, span.start)
        column, score, ids, at = best.held.T
        yield pd.DataFrame({"anchor": block.rows[column], "score": score, "id": ids, "row": at})

    return _merged(map_frames(rows, run, "anchor long, score long, id long, row long"), ["anchor"], k)


def first_in_range(rows: DataFrame, anchors: pd.DataFrame, positives: pd.DataFrame, dims: int, planes: int, k: int, low: int, high: int) -> DataFrame:
    """anchor, positive, score, id, row, rank: the first ``k`` rows of another label that score ``low`` to ``high`` percent of each positive."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, positives))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, positives = shared.value
        block, turns = Block(anchors, dims, planes), []
        place = {r: i for i, r in enumerate(block.rows)}
        for _, group in positives.assign(column=positives["anchor"].map(place)).sort_values("column").groupby("rank"):  # one positive of each anchor
            least = np.array([-(-low * int(x) // 100) for x in group["score"]], np.int64)
            most = np.array([high * int(x) // 100 for x in group["score"]], np.int64)
            turns.append((group["column"].to_numpy(), least, most, Best(len(group), k), group["row"].to_numpy()))
        for ids, at, labels, span, score in block.scored(frames):
            other = labels[:, None] != block.labels[span]
            for column, least, most, best, _ in turns:
                x, y = np.searchsorted(column, [span.start, span.stop])
                part = score[:, column[x:y] - span.start]
                best.add(part, other[:, column[x:y] - span.start] & (part >= least[x:y]) & (part <= most[x:y]), ids, at, x)
        for column, _, _, best, positive in turns:
            at_column, score, ids, at = best.held.T
            yield pd.DataFrame({"anchor": block.rows[column[at_column]], "positive": positive[at_column], "score": score, "id": ids, "row": at})

    return _merged(map_frames(rows, run, "anchor long, positive long, score long, id long, row long"), ["anchor", "positive"], k)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite components whose scores fit 64 bits."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"), F.lit(2)))
    return rows.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).where(length < MAX_SQUARE)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    vector: str = "embedding", id_column: str = "vec_id", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is the integer inner product with the anchor; higher scores
    come first, ties by smaller id, then by row.  An anchor's positives are the
    first other rows of its label; for each, the first rows of other labels that
    score ``low`` to ``high`` percent of the positive are its negatives.

    Rows with a null id, label, vector or component, with a component that isn't
    finite, or with a squared length of 2^61 or more after scaling, take no
    part.  Vectors of different lengths meet on the components both have; an
    empty one scores 0.  Repeated rows are rows of their own: a copy of an
    anchor is another row, and a repeated anchor is mined as often as it occurs.
    An empty table, or one without anchors, gives an empty one.  Other columns
    play no part, whatever their names.
    """
    spark = rows.sparkSession
    named = rows.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
    chosen = usable(named, vector).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        scaled(F.col(vector)).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    base = stored(chosen)
    largest = F.array_max(F.transform("v", lambda x: F.when(x < 0, -1 - x).otherwise(x)))
    dims, most, count = base.agg(F.max(F.size("v")), F.max(largest), F.count_if("is_anchor")).first()
    dims, planes = max(dims or 0, 1), int(most or 0).bit_length() + 1
    blocks = max(-(-count // ANCHORS), 1)
    packed = packed_rows(base.select("row", "id", "label", "v"), planes, dims)
    anchors = stored(base.where("is_anchor").select("row", "id", "label", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")))
    found = []
    for block in range(blocks):
        some = anchors.where(F.col("block") == block).select("row", "id", "label", "v").toPandas()  # ANCHORS rows on average
        if not len(some):
            continue
        first = first_of_label(packed, some, dims, planes, positives).toPandas()  # a few rows for each of them
        near = first_in_range(packed, some, first, dims, planes, negatives, low, high)
        names = spark.createDataFrame(some[["row", "id"]].rename(columns={"row": "anchor", "id": "anchor_id"}), "anchor long, anchor_id long")
        pairs = spark.createDataFrame(
            first[["anchor", "row", "id", "score"]].set_axis(["anchor", "positive", "positive_id", "positive_score"], axis=1),
            "anchor long, positive long, positive_id long, positive_score long",
        )
        met = near.join(F.broadcast(pairs), ["anchor", "positive"]).join(F.broadcast(names), "anchor")
        found.append(stored(met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)
