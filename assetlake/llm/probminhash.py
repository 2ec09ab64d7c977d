"""Near-duplicate documents: ProbMinHash signatures of shingles, banded and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import components, forest, free_name, freeze, slices, spread, text_bytes
from assetlake.llm.words import mix, names, runs

WORDS = 5
SIMILARITY = 0.8
#: 24 bands of 4 registers miss a pair of similarity 0.8 with a probability of 3e-6. Links are defined
#: by sets, so in these every shingle weighs the same. In further bands a shingle weighs as often as it
#: stands in its text: they find texts that differ in many rare shingles but share what is repeated.
BANDS, ROWS = 24, 4
WEIGHTED = 8
#: Members of a bucket that one task compares; larger buckets are compared block by block.
BLOCK = 256
_GOLD = 0x9E3779B97F4A7C15


def word_spans(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text and the end); words end at space, tab to return."""
    return runs(~((raw == 32) | ((raw >= 9) & (raw <= 13))), offsets)


def word_hashes(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name of each word, first word of each text and the end)."""
    start, end, first = word_spans(offsets, raw)
    return names(raw, start, end), first


def prints(raw: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """Digest of the bytes of all words of each text, one space after each; null without words."""
    length = end - start
    at = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[spread(at, length)] = raw[spread(start, length)]
    data, at = memoryview(joined.tobytes()), np.append(at, len(joined))
    ends = at[first].tolist()
    return [hashlib.blake2b(data[a:b], digest_size=16).digest() if b > a else None for a, b in zip(ends[:-1], ends[1:], strict=True)]


def shingles(words: np.ndarray, first: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count), by text and shingle, of runs of ``width`` words.

    A text of fewer words has one shingle of them all; one without words has none.
    """
    n_words = np.diff(first)
    factors = [np.uint64(pow(_GOLD | 1, 2 * k + 1, 1 << 64)) for k in range(width)]
    text = np.repeat(np.arange(len(n_words)), n_words)
    out = [np.empty(0, np.uint64)]
    owner = [np.empty(0, np.int64)]
    if len(words) >= width:
        last = len(words) - width + 1
        same = text[:last] == text[width - 1 :]
        total = np.zeros(last, np.uint64)
        for k in range(width):
            total += words[k : k + last] * factors[k]
        out.append(total[same])
        owner.append(text[:last][same])
    few = np.flatnonzero((n_words > 0) & (n_words < width))
    total = n_words[few].astype(np.uint64)
    for k in range(width - 1):
        has = n_words[few] > k
        total[has] += words[first[few][has] + k] * factors[k]
    out.append(total)
    owner.append(few)
    values, texts = mix(np.concatenate(out)), np.concatenate(owner)
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(new)
    return texts[at], values[at], np.diff(np.append(at, len(values)))


def signatures(texts: np.ndarray, values: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) shingles that arrive first in each register; equal with the probability Jaccard.

    Every shingle sends a Poisson process whose rate is its weight, drawn from its own hash; each
    arrival goes to one register, which keeps the earliest. A shingle stops as soon as its next
    arrival is later than all registers of its text.
    """
    when = np.full(n * m, np.inf)
    who = np.zeros(n * m, np.uint64)
    texts, values, rate = texts.copy(), values.copy(), 1.0 / weights
    now = np.zeros(len(values))
    step = 0
    while len(values):
        step += 1
        draw = mix(values + np.uint64((step * _GOLD) % (1 << 64)))
        now = now - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * rate
        register = texts * m + (mix(draw ^ np.uint64(_GOLD)) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(now < when[register])
        better = better[np.argsort(-now[better], kind="stable")]  # the earliest is written last
        when[register[better]] = now[better]
        who[register[better]] = values[better]
        active = now < when.reshape(n, m).max(axis=1)[texts]
        texts, values, rate, now = texts[active], values[active], rate[active], now[active]
    return who.reshape(n, m)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), np.uint64)
    for k in range(rows):
        out = mix(out + signature[:, k::rows][:, :bands] + np.uint64(k + 1))
    return mix(out + np.arange(bands, dtype=np.uint64) * np.uint64(_GOLD))


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, mark, print, bands): print is a digest of the words; it and the bands are null without words.

    mark is a hash of the text: (id, mark) leads back to the text also where texts share an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2, 2 << 20):
            offsets, raw = text_bytes(part.column(2))
            start, end, first = word_spans(offsets, raw)
            texts, values, count = shingles(names(raw, start, end), first, width)
            n = part.num_rows
            bits = [
                band_hashes(signatures(texts, values, weight, n, k * rows), k, rows) ^ np.uint64(salt)
                for k, weight, salt in ((bands, np.ones(len(values)), 0), (WEIGHTED, count.astype(float), 1))
            ]
            empty = np.diff(first) == 0
            flat = pa.array(np.hstack(bits).astype(np.int64).ravel())
            ends = np.arange(0, (n + 1) * (bands + WEIGHTED), bands + WEIGHTED)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array(empty))
            columns = [*part.columns[:2], pa.array(prints(raw, start, end, first), pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "print", "bands"])

    return marked(docs, id_col, text_col).mapInArrow(run, "id bigint, mark bigint, print binary, bands array<bigint>")


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def similar_rows(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of sorted sets whose Jaccard similarity reaches the threshold, exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n <= 6:
        pairs = []
        for i in range(n):
            for j in range(i + 1, n):
                if min(sizes[i], sizes[j]) >= similarity * max(sizes[i], sizes[j]):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both >= similarity * (sizes[i] + sizes[j] - both):
                        pairs.append((i, j))
        found = np.array(pairs, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    shared = np.zeros((n, n), np.float32)
    step = 2048
    for at in range(0, int(place[-1]) + 1, step):
        a, b = np.searchsorted(place, [at, at + step])
        table = np.zeros((n, step), np.float32)
        table[owner[a:b], place[a:b] - at] = 1
        shared += table @ table.T
    shared = shared.astype(np.float64)  # sums below 2 ** 24 are exact
    links = np.triu(shared >= similarity * (sizes[:, None] + sizes[None, :] - shared), 1)
    return np.nonzero(links)


def link_buckets(members: DataFrame, width: int, similarity: float) -> DataFrame:
    """(lo, hi): prints of links that join, in each bucket, what is linked there; fewer than its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks()
            key = np.array(rows.column("key").combine_chunks())
            cut = int(np.flatnonzero(key == key[-1])[0])  # the last bucket may go on
            if cut:
                yield from linked(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield from linked(pa.Table.from_batches(held).combine_chunks())

    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key = np.array(rows.column("key").combine_chunks())
        own = rows.column("print").combine_chunks()
        rank = np.empty(len(own), np.int64)
        rank[np.array(pc.sort_indices(own))] = np.arange(len(own))
        offsets, raw = text_bytes(rows.column("text").combine_chunks())
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        lo, hi, a = [], [], 0
        while a < len(key):
            b = int(ends[np.searchsorted(ends, a, "right")])
            while b < len(key):  # several whole buckets at once, while their texts are short
                c = int(ends[np.searchsorted(ends, b, "right")])
                if offsets[c] - offsets[a] > 1 << 20:
                    break
                b = c
            words, first = word_hashes(offsets[a : b + 1] - offsets[a], raw[offsets[a] : offsets[b]])
            texts, values, _ = shingles(words, first, width)
            bounds = np.searchsorted(texts, np.arange(b - a + 1))
            s = a
            while s < b:
                e = int(ends[np.searchsorted(ends, s, "right")])
                sets = [values[bounds[i - a] : bounds[i - a + 1]] for i in range(s, e)]
                order = np.argsort(rank[s:e], kind="stable")
                i, j = similar_rows([sets[k] for k in order], similarity)
                if len(i):
                    root = forest(e - s, i, j)
                    moved = np.flatnonzero(root != np.arange(e - s))
                    lo.append(s + order[root[moved]])
                    hi.append(s + order[moved])
                s = e
            a = b
        if lo:
            ends = [own.take(pa.array(np.concatenate(x))) for x in (lo, hi)]
            yield pa.RecordBatch.from_arrays(ends, ["lo", "hi"])

    return members.mapInArrow(run, "lo binary, hi binary")


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """(id, mark, copy_of, component_id, kept) for every row of ``docs``.

    Texts are known by their print throughout, so those that share an id stay apart.
    """
    marks = freeze(sketch(docs, id_col, text_col, width, BANDS, ROWS), "sketch")
    known = marks.where("id is not null and print is not null")
    classes = known.groupBy("print").agg(F.min(F.struct("id", "mark")).alias("one"), F.first("bands").alias("bands"))
    classes = freeze(classes, "classes")
    bands = classes.select("print", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("print")).alias("x"), F.min("print").alias("m")
    ).where("n > 1")
    buckets = buckets.groupBy("n", "x", "m").agg(F.min("band").alias("band"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = bands.join(buckets.select("band", blocks.alias("blocks")), "band").withColumn(
        "own", F.pmod(F.xxhash64("print", "band"), F.col("blocks"))
    )
    members = freeze(members, "members")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = members.select("print", "band", "own", other.alias("other"))
    key = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    members = members.select("print", key.alias("key")).distinct()
    # as many as near-duplicates: never broadcast
    wanted = members.select("print").distinct().join(classes.select("print", "one.*"), "print").hint("merge")
    texts = marked(docs, id_col, text_col).join(wanted, ["id", "mark"]).dropDuplicates(["print"]).select("print", "text")
    rows = members.join(texts, "print").select("key", "print", "text")
    links = link_buckets(rows.repartition("key").sortWithinPartitions("key"), width, similarity)
    found = components(freeze(links, "links"), "lo", "hi").join(classes.select(F.col("print").alias("node"), "one"), "node")
    first = found.groupBy("component").agg(F.min("one").alias("first"))
    linked = found.join(first, "component").select(F.col("node").alias("print"), "first")
    named = classes.select("print", "one").join(linked, "print", "left")
    named = freeze(named.select("print", "one", F.coalesce("first", "one").alias("first")), "named")
    out = known.select("id", "mark", "print").join(named, "print").select(
        "id", "mark", F.col("one")["id"].alias("copy_of"), F.col("first")["id"].alias("component_id"),
        (F.struct("id", "mark") == F.col("first")).alias("kept"),
    )
    alone = marks.where("id is null or print is null").select(
        "id", "mark", F.col("id").alias("copy_of"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(alone)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, copy_of, component_id, kept) for every document.

    Two texts are linked when the Jaccard similarity of their sets of ``width``-word shingles is at
    least ``similarity``; a component is what links reach, named by its smallest id, which is kept.
    copy_of is the smallest id with the same words. Candidates come from bands of ProbMinHash
    signatures, of shingles that weigh the same and of shingles weighed by their count; every link
    is verified on whole texts.

    Copies are folded before banding. Buckets with the same members are compared once; a bucket of
    more than ``BLOCK`` texts is cut into blocks that are compared two by two, all of them.

    Rows with a null id or without words link with nothing and are kept, their component being
    their own id. Different texts that share an id are compared and kept or not by themselves.
    """
    out = grouped(docs, id_col, text_col, width, similarity)
    return out.select(F.col("id").alias("doc_id"), "copy_of", "component_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, and every row without an id or without words.

    A kept document that is stored several times is kept once; rows with a null id are all kept, and so
    are different texts that share an id, unless they are linked to others.
    """
    groups = freeze(grouped(docs, "doc_id", "text", WORDS, SIMILARITY), "components")
    mark = free_name(docs, "mark_")
    dropped = groups.where("not kept").select(F.col("id").alias("doc_id"), F.col("mark").alias(mark)).distinct()
    rest = docs.where("doc_id is not null").withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    rest = rest.join(dropped, ["doc_id", mark], "left_anti").dropDuplicates(["doc_id", mark]).drop(mark)
    return rest.unionByName(docs.where("doc_id is null")).select(*docs.columns)


GROUPS_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {WORDS}
    THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
    ELSE [array_to_string(w, ' ')] END) AS g
  FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE shared >= {SIMILARITY} * (x.n + y.n - shared)),
r(a, b) AS (SELECT DISTINCT a, a FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY w) END AS copy_of,
  coalesce(m.component_id, doc_id) AS component_id,
  coalesce(doc_id = coalesce(m.component_id, doc_id), TRUE) AS kept
FROM d LEFT JOIN m ON m.a = doc_id
"""
