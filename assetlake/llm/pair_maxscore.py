"""Ranked lexical search: MaxScore whose bounds come from pairs of terms as well as single ones.

An index block holds the postings of some documents as impacts, the largest impact of each term and,
for pairs of terms that a query asks for together, the largest sum of both impacts in the documents
that hold both. Two terms that never meet, or meet only where they are weak, then bound a document
by less than the sum of their own maxima, so more terms are too weak to make a document a candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.llm.common import freeze, slices, spread, text_bytes
from assetlake.llm.words import lower_ascii, names, runs

TOP = 50
#: Items and terms of a block of queries: one block is on the driver and with every task at a time.
ITEMS, TERMS = 1024, 1 << 17
#: Postings and documents of an index block.
POSTINGS, DOCUMENTS = 1 << 20, 1 << 16
#: One index block in so many, by its number, is searched first for a threshold to start from.
FIRST_PASS = 16
_LAST = np.iinfo(np.int64).max
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, first): runs of letters, digits and signs beyond ASCII; A to Z in lower case."""
    offsets, raw = text_bytes(column)
    raw = lower_ascii(raw)
    return raw, *runs(_TERM[raw], offsets)


@dataclass
class Queries:
    """A block of items: sorted names and bytes of their different terms, and each item's terms by number."""

    ids: list
    keys: np.ndarray
    raw: np.ndarray
    bounds: np.ndarray
    terms: list[np.ndarray]

    @staticmethod
    def of(items: list[tuple[object, set[bytes]]]) -> Queries:
        words = sorted({w for _, ws in items for w in ws})
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        raw, starts = np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], ends[:-1])) if words else ends
        keys = names(raw, starts, ends)
        order = np.argsort(keys)
        if (np.diff(keys[order].view(np.int64)) == 0).any():
            raise ValueError("two terms of the queries have the same 64-bit name")
        words = [words[i] for i in order.tolist()]
        place = {w: i for i, w in enumerate(words)}
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
        terms = [np.array(sorted(place[w] for w in ws), np.int64) for _, ws in items]
        return Queries([i for i, _ in items], keys[order], np.frombuffer(b"".join(words), np.uint8), bounds, terms)

    def find(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each term, -1 if no item has it; names lead to it, bytes decide."""
        if not len(self.keys):
            return np.full(len(start), -1)
        key = names(raw, start, end)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        length = end - start
        hit = np.flatnonzero((self.keys[at] == key) & (np.diff(self.bounds)[at] == length))
        same = raw[spread(start[hit], length[hit])] == self.raw[spread(self.bounds[at[hit]], length[hit])]
        wrong = np.concatenate(([0], np.cumsum(~same)))
        ends = np.cumsum(length[hit])
        out = np.full(len(start), -1)
        right = wrong[ends] == wrong[ends - length[hit]]
        out[hit[right]] = at[hit[right]]
        return out


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """Blocks of items with their terms, one after the other; an item has the terms of all rows with its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            raw, start, end, first = terms_of(batch.column(1))
            data, start, end = raw.tobytes(), start.tolist(), end.tolist()
            lists = [sorted({data[start[k] : end[k]] for k in range(a, b)}) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.binary()))], ["item", "terms"])

    rows = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, "item long, terms array<binary>").where(F.size("terms") > 0)
    held: list[tuple[object, set[bytes]]] = []
    size = 0
    for row in found.orderBy("item").toLocalIterator():
        own = set(map(bytes, row["terms"]))
        if held and held[-1][0] == row["item"]:
            held[-1][1].update(own)
        else:
            if len(held) >= ITEMS or size + len(own) > TERMS and held:
                yield Queries.of(held)
                held, size = [], 0
            held.append((row["item"], own))
        size += len(own)
    if held:
        yield Queries.of(held)


def postings(docs: DataFrame, queries: Queries, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, terms, tf) of every document with a term at all: n counts all its terms, the lists the asked ones."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            raw, start, end, first = terms_of(part.column(1))
            n = np.diff(first)
            number = shared.value.find(raw, start, end)
            doc = np.repeat(np.arange(len(n)), n)[number >= 0]
            pair, tf = np.unique(doc << 32 | number[number >= 0], return_counts=True)
            bounds = pa.array(np.searchsorted(pair >> 32, np.arange(len(n) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (pair & 0xFFFFFFFF, tf)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *lists], ["doc", "n", "terms", "tf"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, "doc long, n long, terms array<int>, tf array<int>").where("n > 0")
    return freeze(found, "postings")


def weights(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms of them all, weight of each asked term) over all documents."""
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    count, length = total["n"], total["l"] or 0
    out = np.zeros(size, np.int64)
    for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        out[r["term"]] = math.floor(1000 * math.log((2 * count + 2) / (2 * r["count"] + 1)))
    return count, length, out


def pairing(queries: Queries, weight: np.ndarray) -> list[np.ndarray]:
    """For each item its terms by weight, neighbours of which are pairs; the last one may be alone."""
    return [ts[np.argsort(weight[ts], kind="stable")] for ts in queries.terms]


@dataclass
class Block:
    """Postings by term: documents and impacts; largest impact of each term, and joint one of each pair."""

    docs: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    doc: np.ndarray
    impact: np.ndarray
    largest: np.ndarray
    pairs: np.ndarray
    joint: np.ndarray

    FIELDS = ("docs", "terms", "starts", "doc", "impact", "largest", "pairs", "joint")

    @staticmethod
    def of(docs: np.ndarray, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, asked: np.ndarray) -> Block:
        """``asked`` holds pairs of terms as a << 32 | b, sorted; the pairs whose terms both occur get a joint maximum."""
        order = np.argsort(term, kind="stable")
        term, doc, impact = term[order], owner[order], impact[order]
        terms, starts = np.unique(term, return_index=True)
        starts = np.append(starts, len(term))
        largest = np.maximum.reduceat(impact, starts[:-1]) if len(terms) else np.empty(0, np.int64)
        places = [np.minimum(np.searchsorted(terms, x), len(terms) - 1) for x in (asked >> 32, asked & 0xFFFFFFFF)]
        both = np.flatnonzero((terms[places[0]] == asked >> 32) & (terms[places[1]] == asked & 0xFFFFFFFF)) if len(terms) else []
        pairs = asked[both] if len(both) else np.empty(0, np.int64)
        joint = np.zeros(len(pairs), np.int64)
        for k, i in enumerate(both):
            lists = [slice(starts[p[i]], starts[p[i] + 1]) for p in places]
            short, long = sorted(lists, key=lambda s: s.stop - s.start)
            at = np.minimum(np.searchsorted(doc[long], doc[short]), long.stop - long.start - 1)
            meet = doc[long][at] == doc[short]
            if meet.any():
                joint[k] = (impact[long][at[meet]] + impact[short][meet]).max()
        return Block(docs, terms, starts, doc.astype(np.int32), impact, largest, pairs, joint)

    def place(self, term: int) -> int | None:
        i = int(np.searchsorted(self.terms, term))
        return i if i < len(self.terms) and self.terms[i] == term else None

    def units(self, terms: np.ndarray) -> list[tuple[int, list[int]]]:
        """(bound, places of terms), by rising bound: no document gets more from these terms."""
        out = []
        for i in range(0, len(terms), 2):
            two = terms[i : i + 2]
            places = [p for p in map(self.place, two.tolist()) if p is not None]
            if not places:
                continue
            bound = int(self.largest[places].max())
            if len(places) == 2:
                bound = max(bound, int(self.joint[np.searchsorted(self.pairs, pair_key(*two.tolist()))]))
            out.append((bound, places))
        return sorted(out)

    def search(self, terms: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(score, document number) of all documents with a score above 0 and of at least ``least``.

        Units of terms whose bounds add up to less than ``least`` name no candidates. Candidates are scored by
        the other units, then by those, strongest first, and given up as soon as what is
        left cannot lift them to ``least``.
        """
        units = self.units(terms)
        bounds = np.concatenate(([0], np.cumsum([u[0] for u in units], dtype=np.int64)))
        weak = int(np.searchsorted(bounds, least, "left")) - 1 if least > 0 else 0
        weak = min(max(weak, 0), len(units))
        if weak == len(units):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        score = np.zeros(len(self.docs), np.int64)
        for _, places in units[weak:]:
            for p in places:
                own = slice(self.starts[p], self.starts[p + 1])
                score[self.doc[own]] += self.impact[own]
        found = np.flatnonzero(score)
        score = score[found]
        for k in range(weak, -1, -1):
            keep = score + bounds[k] >= least
            found, score = found[keep], score[keep]
            if k == 0 or not len(found):
                break
            for p in units[k - 1][1]:
                own = slice(self.starts[p], self.starts[p + 1])
                at = np.minimum(np.searchsorted(self.doc[own], found), own.stop - own.start - 1)
                score = score + np.where(self.doc[own][at] == found, self.impact[own][at], 0)
        return score, found


def pair_key(a: int, b: int) -> int:
    return min(a, b) << 32 | max(a, b)


_BLOCK_SCHEMA = "number long, " + ", ".join(f"{c} binary" for c in Block.FIELDS)


def index_blocks(found: DataFrame, count: int, length: int, weight: np.ndarray, asked: np.ndarray) -> DataFrame:
    """Index blocks of the postings, frozen: impacts by term, maxima of terms and of the pairs asked for."""
    shared = found.sparkSession.sparkContext.broadcast((weight, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        docs = size = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, 4096)
                at += part.num_rows
                held.append(part)
                docs += part.num_rows
                size += len(part.column(2).flatten())
                if docs >= DOCUMENTS or size >= POSTINGS:
                    yield made(held)
                    held, docs, size = [], 0, 0
        if held and docs:
            yield made(held)

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        weight, asked = shared.value
        rows = pa.Table.from_batches(held).combine_chunks()
        lists = rows.column("terms").combine_chunks()
        owner = np.repeat(np.arange(rows.num_rows), np.array(lists.value_lengths()))
        term = lists.flatten().to_numpy().astype(np.int64)
        tf = rows.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
        m = 50 + 50 * rows.column("n").to_numpy() * count // length
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[owner]))
        ids = rows.column("doc").combine_chunks().fill_null(_LAST).to_numpy()
        block = Block.of(ids, owner, term, impact, asked)
        number = int(np.bitwise_xor.reduce(ids * 0x9E3779B97F4A7C1 + 7)) if len(ids) else 0
        row = [pa.array([number], pa.int64()), *[pa.array([getattr(block, c).tobytes()], pa.binary()) for c in Block.FIELDS]]
        return pa.RecordBatch.from_arrays(row, ["number", *Block.FIELDS])

    return freeze(found.mapInArrow(run, _BLOCK_SCHEMA), "index-blocks")


def best(blocks: DataFrame, terms: list[np.ndarray], least: np.ndarray, top: int) -> DataFrame:
    """(item, score, doc): of every task the ``top`` best documents of each item that reach its ``least``."""
    shared = blocks.sparkSession.sparkContext.broadcast((terms, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, least = shared.value
        least = least.copy()
        scores = [np.empty(0, np.int64)] * len(terms)
        docs = [np.empty(0, np.int64)] * len(terms)
        for batch in batches:
            for k in range(batch.num_rows):
                fields = {c: batch.column(c)[k].as_buffer() for c in Block.FIELDS}
                block = Block(**{c: np.frombuffer(v, np.int32 if c == "doc" else np.int64) for c, v in fields.items()})
                for i, own in enumerate(terms):
                    score, found = block.search(own, int(least[i]))
                    if not len(score):
                        continue
                    score, doc = np.concatenate([scores[i], score]), np.concatenate([docs[i], block.docs[found]])
                    order = np.lexsort((doc, -score))[:top]
                    scores[i], docs[i] = score[order], doc[order]
                    if len(order) == top:
                        least[i] = max(least[i], int(scores[i][-1]))
        item = np.repeat(np.arange(len(terms)), [len(s) for s in scores])
        if len(item):
            score, doc = np.concatenate(scores), np.concatenate(docs)
            doc = pa.array(doc, mask=doc == _LAST)
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(score), doc], ["item", "score", "doc"])

    return blocks.mapInArrow(run, "item int, score long, doc long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    Every row of ``docs`` is a document, also with a repeated or null id; null ids go last among equal
    scores. Null texts and texts without a term have none and do not count. Items come in blocks of
    bounded size, all documents are searched for each block. What a sample of the index
    blocks gives is a threshold from below for the search of all of them, so no document is lost.
    """
    spark = docs.sparkSession
    schema = T.StructType.fromDDL("item_id long, rank int, doc_id long, score long")
    out = None
    for queries in query_blocks(items, item_id, text_col):
        found = postings(docs, queries, doc_id, text_col)
        count, length, weight = weights(found, len(queries.keys))
        if not length:
            continue
        terms = pairing(queries, weight)
        asked = np.unique([pair_key(*ts[i : i + 2].tolist()) for ts in terms for i in range(0, len(ts) - 1, 2)]).astype(np.int64)
        blocks = index_blocks(found, count, length, weight, asked)
        least = np.ones(len(terms), np.int64)
        part = best(blocks.where(F.pmod("number", F.lit(FIRST_PASS)) == 0), terms, least, top)
        for r in ranked(part, top).where(F.col("rank") == top).select("item", "score").collect():
            least[r["item"]] = r["score"]
        rows = ranked(best(blocks, terms, least, top), top)
        ids = spark.createDataFrame(list(enumerate(queries.ids)), "item int, item_id long")  # at most ITEMS rows
        rows = rows.join(F.broadcast(ids), "item").select(
            "item_id", "rank", F.col("doc").alias("doc_id"), "score"
        )
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS_SQL = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
DIGEST_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS ts FROM documents),
s AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS terms FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark),
p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, s GROUP BY term, docs),
x AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id),
o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
