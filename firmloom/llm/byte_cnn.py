"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover all of it.  Each
byte is a learned vector, with one more input that says whether the last bytes
repeat what stood shortly before.  Learned filters run over every chunk and are
max-pooled; largest and mean pooled values over the chunks are combined into
one probability.  Training takes a bounded sample on the driver; the weights
are a few kilobytes and travel with the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmloom.llm.common import table
from firmloom.session import map_frames

#: Labelled documents of each class that training takes (those with the smallest hash), of at most so many bytes each.
TRAIN_ROWS = 400
TRAIN_BYTES = 16_384
CHUNK, STEP, STRIDE = 256, 192, 2
WIDTH, VECTOR, FILTERS = 6, 6, 24
EPOCHS, BATCH, RATE, SEED = 10, 16, 0.01, 5
#: A repeat is this many bytes that stood the same 2 .. LAGS bytes before.
REPEAT, LAGS = 6, 16
#: Bytes whose filter inputs are laid out at once.
BLOCK_BYTES = 1 << 19


def repeats(data: np.ndarray) -> np.ndarray:
    """1 where the last REPEAT bytes equal those some 2 .. LAGS places before, else 0."""
    out = np.zeros(len(data), np.float32)
    for lag in range(2, LAGS + 1):
        if len(data) <= lag + REPEAT:
            break
        run = np.cumsum(data[lag:] == data[:-lag], dtype=np.int32)
        full = run[REPEAT:] - run[:-REPEAT] == REPEAT
        out[lag + REPEAT :][full] = 1
    return out


def chunk_starts(n: int) -> np.ndarray:
    """First bytes of the overlapping chunks of n bytes (n >= CHUNK)."""
    return np.unique(np.append(np.arange(0, n - CHUNK + 1, STEP), n - CHUNK))


@dataclass
class Network:
    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        return cls(
            rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32), rng.normal(0, (WIDTH * (VECTOR + 1)) ** -0.5, (WIDTH * (VECTOR + 1), FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32),
        )

    def pooled(self, data: np.ndarray, places: bool = False):
        """Max-pooled filter values of every chunk, and with ``places`` where each maximum stood and the padded bytes."""
        if len(data) < CHUNK:
            data = np.concatenate((data, np.zeros(CHUNK - len(data), np.uint8)))
        again = repeats(data)
        starts = chunk_starts(len(data))
        windows = (CHUNK - WIDTH) // STRIDE + 1
        best, where = np.empty((len(starts), FILTERS), np.float32), np.empty((len(starts), FILTERS), np.int64)
        some = max(BLOCK_BYTES // CHUNK, 1)
        inner = np.arange(windows)[:, None] * STRIDE + np.arange(WIDTH)
        for at in range(0, len(starts), some):
            index = starts[at : at + some, None, None] + inner
            x = np.concatenate((self.vectors[data[index]], again[index][..., None]), axis=-1)
            y = x.reshape(-1, WIDTH * (VECTOR + 1)) @ self.filters
            y = y.reshape(len(index), windows, FILTERS)
            top = y.argmax(axis=1)
            best[at : at + some] = np.take_along_axis(y, top[:, None], axis=1)[:, 0]
            if places:
                where[at : at + some] = starts[at : at + some, None] + top * STRIDE
        best = np.maximum(best + self.bias, 0)
        return (best, where, data, again) if places else best

    def probability(self, text: str | None) -> float:
        best = self.pooled(np.frombuffer((text or "").encode(), np.uint8))
        z = np.concatenate((best.max(axis=0), best.mean(axis=0))) @ self.head + self.offset[0]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradients(self, data: np.ndarray, label: int, weight: float) -> list[np.ndarray]:
        best, where, data, again = self.pooled(data, places=True)
        n = len(best)
        summary = np.concatenate((best.max(axis=0), best.mean(axis=0)))
        z = float(summary @ self.head + self.offset[0])
        slope = np.float32((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * weight)
        grad = np.repeat(slope * self.head[FILTERS:][None] / n, n, axis=0)
        grad[best.argmax(axis=0), np.arange(FILTERS)] += slope * self.head[:FILTERS]
        grad *= best > 0
        index = where[..., None] + np.arange(WIDTH)
        x = np.concatenate((self.vectors[data[index]], again[index][..., None]), axis=-1).reshape(n, FILTERS, -1)
        g_filters = np.einsum("cfi,cf->if", x, grad)
        g_x = (grad[..., None] * self.filters.T[None]).reshape(n, FILTERS, WIDTH, VECTOR + 1)[..., :VECTOR]
        g_vectors = np.zeros_like(self.vectors)
        np.add.at(g_vectors, data[index].reshape(-1), g_x.reshape(-1, VECTOR))
        return [g_vectors, g_filters.astype(np.float32), grad.sum(axis=0), slope * summary, np.array([slope])]


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Train on texts with labels 0 and 1, both classes weighing the same (Adam, fixed seed)."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    share = np.bincount(labels, minlength=2)
    weights = [len(labels) / (2 * max(share[label], 1)) for label in labels]
    params = [net.vectors, net.filters, net.bias, net.head, net.offset]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            grads = [net.gradients(data[i], labels[i], weights[i] / len(batch)) for i in batch]
            step += 1
            for k, p in enumerate(params):
                g = np.sum([x[k] for x in grads], axis=0)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                p -= (RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def remainder(doc_id: str) -> Column:
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network | None:
    """A network from at most ``rows`` labelled documents of each class, or None if a class has none.

    Documents whose crc32(doc_id as text) mod 3 is 1 are kept out, and so are
    documents of more than TRAIN_BYTES bytes.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & (remainder("doc_id") != 1)).select("doc_id", "quality").distinct()
    short = docs.where(F.octet_length("text") <= TRAIN_BYTES).select("doc_id", "text")
    chosen = None
    for label in (0, 1):
        some = usable.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    sample = short.join(F.broadcast(chosen), "doc_id").toPandas()  # at most 4 * rows ids, TRAIN_BYTES each
    sample["rank"] = pd.util.hash_array(sample["doc_id"].to_numpy())
    sample = sample.sort_values(["rank", "doc_id", "text"]).groupby("quality").head(rows)
    if sample["quality"].nunique() < 2:
        return None
    return fit(sample["text"].tolist(), sample["quality"].astype(int).tolist())


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Only the text is read for a score.  A null text counts as empty, and an
    empty one is scored like any other.  Without documents to learn from in
    both classes every score is 0.5.  A null doc_id is not held out.
    """
    net = train(docs, labels)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"], "score": [0.5 if net is None else net.probability(t) for t in f["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "text")
    scored = map_frames(rows, run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
