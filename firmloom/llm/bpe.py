"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a batch of documents form one small corpus.  An inverted
index leads from each token pair to the positions where it stands; merges are
replayed in rank order over that corpus, and each merge touches only the two
neighbours of the position it joins.  Every task replays its own batches, so
nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from firmloom.llm.common import table
from firmloom.session import map_frames

#: Words whose ids a worker remembers between batches.
CACHE_WORDS = 400_000
#: Characters of text whose words are replayed together.
REPLAY_CHARS = 16_000_000


@lru_cache(maxsize=2)
def load_ranks(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ranks by token bytes, and token bytes by rank, of a tiktoken vocabulary file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    names = [b""] * (max(ranks.values()) + 1)
    for name, rank in ranks.items():
        names[rank] = name
    return ranks, names


class MergeReplay:
    """Replays the merges of one vocabulary over sets of words."""

    def __init__(self, path: str):
        ranks, self.names = load_ranks(path)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.shift = int(len(self.names)).bit_length()
        pairs = {}
        for name, rank in ranks.items():
            for cut in range(1, len(name)):
                left, right = ranks.get(name[:cut]), ranks.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << self.shift | right] = rank
        self.codes = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[c] for c in self.codes.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 where there is none."""
        code = left << self.shift | right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, self.made[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian unsigned 32-bit integers.

        The tokens of all words lie in one array; ``after`` and ``before`` link
        the live ones, -1 ends a word.  ``places``, the inverted index, leads
        from the rank of a pair's token to the positions where such a pair was
        seen; ``pair`` holds the rank of the pair that starts at a position, so
        a position that has changed since is told apart.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        token = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        word = np.repeat(np.arange(len(words)), lengths)
        inner = np.zeros(n, bool)
        inner[:-1] = word[1:] == word[:-1]
        after = np.where(inner, np.arange(1, n + 1), -1)
        before = np.full(n, -1)
        before[1:] = np.where(inner[:-1], np.arange(n - 1), -1)
        pair = np.full(n, -1)
        starts = np.flatnonzero(inner)
        pair[starts] = self.rank(token[starts], token[starts + 1])
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter positions under the rank of the pair that starts there."""
            of = pair[at]
            at, of = at[of >= 0], of[of >= 0]
            if len(at) > 1:
                order = np.argsort(of, kind="stable")
                at, of = at[order], of[order]
                cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
                parts = zip(of[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True) if len(cuts) else [(int(of[0]), at)]
            else:
                parts = [(int(of[0]), at)] if len(at) else []
            for rank, part in parts:
                if rank in places:
                    places[rank].append(part)
                else:
                    places[rank] = [part]
                    heappush(heap, rank)

        note(starts)
        while heap:
            now = heappop(heap)
            held = places.pop(now)
            here = held[0] if len(held) == 1 else np.concatenate(held)
            here = here[pair[here] == now]
            if len(here) > 1:
                here = np.unique(here)
                here = _apart(here, after)
            if not len(here):
                continue
            right = after[here]
            beyond, back = after[right], before[here]
            lower = _under(self.rank(np.full(len(here), now), token[beyond]), beyond, now)
            lower |= _under(self.rank(token[back], np.full(len(here), now)), back, now)
            if lower.any():  # a merge makes a pair of a lower rank, which goes first: one place a word, the rest waits
                first = np.ones(len(here), bool)
                first[1:] = word[here[1:]] != word[here[:-1]]
                places[now] = [here[~first]]
                heappush(heap, now)
                here, right, beyond, back = here[first], right[first], beyond[first], back[first]
            token[here], token[right], pair[right] = now, -1, -1
            after[here] = beyond
            linked = beyond >= 0
            before[beyond[linked]] = here[linked]
            pair[here[~linked]] = -1
            joined = here[linked]
            pair[joined] = self.rank(token[joined], token[beyond[linked]])
            back = before[here]
            joined_to, back = here[back >= 0], back[back >= 0]
            pair[back] = self.rank(token[back], token[joined_to])
            note(np.concatenate((joined, back)))
        live = token >= 0
        ends = np.cumsum(np.bincount(word[live], minlength=len(words)) * 4).tolist()
        packed = token[live].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []

    def decode(self, ids: Iterable[int]) -> bytes:
        names = self.names
        return b"".join([names[i] for i in ids])


def _apart(here: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Without the places whose left token is the right token of the place before (as in aaa), from left to right."""
    touching = after[here[:-1]] == here[1:]
    if not touching.any():
        return here
    keep = np.ones(len(here), bool)
    for k in np.flatnonzero(touching).tolist():
        keep[k + 1] = not keep[k]
    return here[keep]


def _under(rank: np.ndarray, at: np.ndarray, now: int) -> np.ndarray:
    return (at >= 0) & (rank >= 0) & (rank < now)


def _batches(texts: list[str], most: int) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


class DocumentCodec:
    """Encodes and decodes documents; remembers a bounded number of words between batches."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.replay = MergeReplay(path)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for part in _batches(texts, REPLAY_CHARS):
            number: dict[str, int] = {}  # a text waits as the numbers of its words, which take a tenth of the words' memory
            docs = [np.fromiter([number.setdefault(w, len(number)) for w in self.split(t)], np.int32) for t in part]
            if len(self.known) > CACHE_WORDS:
                self.known = {}
            known = self.known
            new = [w for w in number if w not in known]
            known.update(zip(new, self.replay.encode([w.encode() for w in new]), strict=True))
            ids = [known[w] for w in number]
            for words in docs:
                yield b"".join([ids[i] for i in words.tolist()])

    def decode(self, packed: bytes) -> bytes:
        return self.replay.decode(memoryview(packed).cast("I"))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, ids (array<int>) and decoded (binary) of every text; null and empty texts have no ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = DocumentCodec(path, pattern)
        for f in frames:
            packed = list(codec.encode([t or "" for t in f["t"]]))
            yield pd.DataFrame({"k": f["k"], "ids": [list(memoryview(p).cast("I")) for p in packed], "decoded": [codec.decode(p) for p in packed]})

    schema = f"k {docs.schema[id_column].dataType.simpleString()}, ids array<int>, decoded binary"
    return map_frames(docs.selectExpr(f"`{id_column}` AS k", f"`{text}` AS t"), run, schema).withColumnRenamed("k", id_column)


def encode_digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256, round_trip of every text, and with ``ids`` the packed 32-bit ids.

    The text is encoded, the ids are decoded again, and both are hashed in the
    same pass.  A null text counts as empty; repeated rows give repeated rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = DocumentCodec(path, pattern)
        sha = hashlib.sha256
        for f in frames:
            texts = [t or "" for t in f["t"]]
            rows = []
            for t, packed in zip(texts, codec.encode(texts), strict=True):
                plain = codec.decode(packed)
                rows.append((len(packed) // 4, sha(packed).hexdigest(), sha(plain).hexdigest(), plain == t.encode(), packed))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "ids"])
            out.insert(0, "k", f["k"].to_numpy())
            yield out if ids else out.drop(columns="ids")

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean{', ids binary' if ids else ''}"
    return map_frames(docs.selectExpr(f"`{id_column}` AS k", f"`{text}` AS t"), run, schema).withColumnRenamed("k", id_column)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return encode_digests(table(spark, sf_dir, "documents"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
