"""Byte-level BPE in two tiers: whole pre-tokens by a minimal perfect hash, the rest by merging."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.llm.common import free_name, slices
from assetlake.llm.pretokens import Store
from assetlake.llm.words import mix, names


class PerfectHash:
    """Minimal perfect hash by displacement: n keys to the places 0 to n - 1, without a gap.

    Keys fall into buckets; from the largest bucket on, each gets the first displacement that sends
    its keys to free places. Two bytes per bucket and none per key are needed to look a key up.
    """

    def __init__(self, keys: np.ndarray, per_bucket: float = 3.0):
        self.n = len(keys)
        self.buckets = max(1, int(self.n / per_bucket))
        bucket = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.uint64)
        free = np.ones(max(self.n, 1), bool)
        for b in np.argsort(-(bounds[1:] - bounds[:-1]), kind="stable"):
            own = keys[order[bounds[b] : bounds[b + 1]]]
            if not len(own):
                break
            tried = 0
            while True:  # a block of displacements at a time
                shifts = np.arange(tried, tried + 64, dtype=np.uint64)
                places = self._place(own[None, :], shifts[:, None])
                good = free[places].all(axis=1)
                if len(own) > 1:
                    ranked = np.sort(places, axis=1)
                    good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if good.any():
                    k = int(np.argmax(good))
                    self.shift[b] = shifts[k]
                    free[places[k]] = False
                    break
                tried += 64

    def _place(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys ^ mix(shift + np.uint64(1))) % np.uint64(max(self.n, 1))).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self._place(keys, self.shift[(keys % np.uint64(self.buckets)).astype(np.int64)])


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def token_hashes(tokens: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(t) for t in tokens])
    raw = np.frombuffer(b"".join(tokens), np.uint8)
    return names(raw, np.concatenate(([0], ends[:-1])), ends)


class Vocabulary:
    """Tokens, their perfect hash and the merge ranks."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        ids = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        hashes = token_hashes([tokens[i] for i in ids])
        self.hash = PerfectHash(hashes)
        self.id_at = np.zeros(len(ids), np.int64)
        self.id_at[self.hash(hashes)] = ids

    def encode(self, pretokens: list[bytes], hashes: np.ndarray) -> list[list[int]]:
        """Ids of each pre-token: its own, where the hash leads to the same bytes, or merged ones."""
        guesses = self.id_at[self.hash(hashes)].tolist()
        return [[g] if self.tokens[g] == p else self.merge(p) for p, g in zip(pretokens, guesses, strict=True)]

    def merge(self, word: bytes) -> list[int]:
        """Merge the adjacent pair of least rank, the leftmost first, until no pair has a rank.

        Parts are linked by the place where the next one starts; the heap holds pairs by rank and
        place, and those whose parts have changed since are skipped.
        """
        ranks, n = self.ranks, len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(word[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if middle <= i or middle >= n or after[middle] != end:
                continue
            after[middle] = -1  # no longer a part
            after[i] = end
            if end < n:
                before[end] = i
                rank = ranks.get(word[i : after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            left = before[i]
            if left >= 0:
                rank = ranks.get(word[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : after[i]]])
            i = after[i]
        return out


@functools.lru_cache(maxsize=2)
def tokens_of(path: str) -> list[bytes]:
    return read_ranks(path)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(tokens_of(path))


@functools.lru_cache(maxsize=2)
def store(path: str) -> Store:
    """The worker's pre-tokens with their ids, kept from task to task."""
    return Store(vocabulary(path).encode)


def encode(docs: DataFrame, path: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """Add ``into``: the ids of the text, without special tokens; empty for a null or empty text.

    ``path`` names a file of base64 tokens and ranks that every worker can read. A column named
    ``into`` is replaced. Each pre-token is encoded by itself, so neither the length of a text nor
    repeated rows change the memory a task needs.
    """
    text = free_name(docs, "text_")
    rows = docs.drop(into).withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    schema = T.StructType([*docs.drop(into).schema.fields, T.StructField(into, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store(path)
        last = len(rows_columns) - 1
        for part in slices(batches, last, 1 << 19):
            ids, bounds = known.encode_texts(part.column(last))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns[:last], lists], [*rows_columns[:last], into])

    rows_columns = rows.columns
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add ``into``: the bytes of the ids, in order; empty for null. Unknown ids raise."""
    base = rows.drop(into)
    names, at = base.columns, [c.lower() for c in base.columns].index(ids_col.lower())
    schema = T.StructType([*base.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            out = [b"".join([tokens[i] for i in x or ()]) for x in _lists(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*names, into])

    return base.mapInArrow(run, schema)


def _lists(column: pa.ListArray) -> Iterator[list[int] | None]:
    values, offsets = column.values, column.offsets.to_pylist()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield values.slice(offsets[i], offsets[i + 1] - offsets[i]).to_numpy(False).tolist() if valid else None


def digest(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: token count and digests of the ids and of the bytes they stand for."""
    out = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
