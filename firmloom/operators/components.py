"""Connected components of a key graph, by contraction of chunks and alternating star steps.

First every chunk of edges, of bounded size, becomes a forest of stars in one
task; paths and dense parts inside a chunk are gone after that.  A graph of one
chunk is done.  For others the two steps of the published large-star /
small-star method follow: every node hangs its larger (then its smaller)
neighbours below the smallest node it knows, until only stars are left.  The
number of rounds grows with the logarithm of the graph, not with its diameter,
and a component that is a star takes no part in later rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from firmloom.session import cut_lineage, map_frames
from firmloom.skew import HOT_KEY_ROWS

#: Edges that one task contracts at once.
CHUNK_EDGES = 1_000_000
#: Most nodes (of 8 bytes) that a join copies to every executor.
BROADCAST_NODES = 1_000_000


def _stars(u: pd.Series, v: pd.Series) -> pd.DataFrame:
    """(u, v): every node of the edges that isn't the smallest of its component, and that smallest node."""
    codes, names = pd.factorize(pd.concat([u, v], ignore_index=True), sort=True)
    a, b = np.split(codes, 2)
    root = np.arange(len(names))
    while (apart := root[a] != root[b]).any():
        x, y = root[a][apart], root[b][apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    child = np.flatnonzero(root != np.arange(len(names)))
    return pd.DataFrame({"u": names[child], "v": names[root[child]]})


def _contract(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for f in frames:
        for start in range(0, len(f), most):
            part = f.iloc[start : start + most]
            if sum(map(len, held)) + len(part) > most:
                whole = pd.concat(held)
                yield _stars(whole["u"], whole["v"])
                held = []
            held.append(part)
    if held:
        whole = pd.concat(held)
        yield _stars(whole["u"], whole["v"])


def _with_min(edges: DataFrame, hot_rows: int) -> DataFrame:
    """Add ``m``, the smallest neighbour of ``u``.

    Hubs with more than ``hot_rows`` edges, of which there are at most
    ``count(edges) / hot_rows``, get it by broadcast; the others by a shuffle
    in which no key is hot.
    """
    mins = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_degree"))
    hubs = F.broadcast(mins.where(F.col("_degree") > hot_rows).select("u", "m"))
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(mins.select("u", "m"), "u")
    return rest.unionByName(edges.join(hubs, "u"))


def _large_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _with_min(both, hot_rows).withColumn("m", F.least("u", "m"))
    return low.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    low = _with_min(edges, hot_rows)
    moved = low.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where(F.col("u") != F.col("v")).distinct()


def _bounded(nodes: DataFrame, count: int) -> DataFrame:
    return F.broadcast(nodes) if count <= BROADCAST_NODES else nodes


def _open_centres(edges: DataFrame) -> tuple[DataFrame, int]:
    """(v, count of them): centres whose component is no star yet.

    A node is bent if it hangs below two nodes, or below one while others hang
    below it.  A node that isn't bent is a leaf of one edge or a centre only, so
    a component without bent nodes is a star, and in others each edge that
    touches no bent node shares its centre with one that does.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("e")).select("e.*")
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    bent = cut_lineage(met.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).select("node"))
    count = bent.count()
    few = _bounded(bent, count)
    below = edges.join(few.withColumnRenamed("node", "u"), "u", "left_semi").select("v")
    centres = cut_lineage(below.unionByName(bent.withColumnRenamed("node", "v")).distinct())
    return centres, centres.count()


def connected_components(pairs: DataFrame, hot_rows: int = HOT_KEY_ROWS, chunk_edges: int = CHUNK_EDGES) -> DataFrame:
    """(node, component) for an edge list with columns ``a`` and ``b`` (null ``b``: a lone node).

    ``component`` is the smallest node of the component.  Edges may come in any
    number of copies; they are made distinct first, with a map-side combine.
    """
    distinct = cut_lineage(pairs.select("a", "b").distinct())
    nodes = distinct.select(F.explode(F.array("a", "b")).alias("node")).where(F.col("node").isNotNull()).distinct()
    linked = distinct.where(F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = linked.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    chunks = -(-edges.count() // chunk_edges)
    # any split into chunks keeps what is connected, so a recomputed task may find another forest
    dealt = edges.repartition(1) if chunks <= 1 else edges.repartition(chunks, "u", "v")
    kind = edges.schema["u"].dataType.simpleString()
    edges = cut_lineage(map_frames(dealt, partial(_contract, most=chunk_edges), f"u {kind}, v {kind}").distinct())
    stars, count = ([edges], 0) if chunks <= 1 else ([], 1)
    while count:
        moved = cut_lineage(_small_star(_large_star(edges, hot_rows), hot_rows))
        centres, count = _open_centres(moved)
        near = _bounded(centres, count)
        stars.append(moved.join(near, "v", "left_anti").select("u", "v") if count else moved)
        edges = cut_lineage(moved.join(near, "v", "left_semi").select("u", "v")) if count else moved
    roots = reduce(DataFrame.unionByName, stars).select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
