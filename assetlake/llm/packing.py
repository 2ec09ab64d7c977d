"""Packing of token pieces into sequences: a configuration LP over the lengths, rounded."""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.common import freeze, slices, text_bytes
from assetlake.llm.pretokens import Store

SEQUENCE = 1024
END_ID = 2
#: Pre-tokens that the library encodes at a time; what it tells of each is many times its ids.
PORTION = 4096
#: Rows that share a rank window: small, so that a length of many pieces is ranked by many tasks.
RANK_ROWS = 128
#: Salts whose counts are summed in one window; their totals are summed in another one.
RANK_SALTS = 1024
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row bigint"


@functools.lru_cache(maxsize=2)
def tokenizer_of(path: str):
    """The tokenizer of a file, loaded once by a worker.

    Tasks are what runs side by side: threads of the library's own, one for each core of the machine
    in every worker, would each keep a heap.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def special_strings(path: str) -> list[bytes]:
    """The strings that the library takes as special tokens wherever they stand in a text."""
    return [t.content.encode() for t in tokenizer_of(path).get_added_tokens_decoder().values()]


@functools.lru_cache(maxsize=2)
def store(path: str) -> Store:
    """Ids by the tokenizers library, asked once for each pre-token a worker does not know."""
    tokenizer = tokenizer_of(path)

    def encode(pretokens: list[bytes], _hashes: np.ndarray) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(pretokens), PORTION):
            texts = [p.decode() for p in pretokens[at : at + PORTION]]
            out += [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return out

    return Store(encode, 700_000)


def pieces(docs: DataFrame, path: str, most: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: its ids with ``end_id`` after them, cut where too long.

    A document of at most ``most`` ids is one piece. A longer one gives pieces of ``most`` ids, but
    the first, which takes what is left over. A null text counts as empty and gives the end id
    alone; repeated rows give repeated pieces. Reads doc_id and text only. The string of a special
    token in a text is that token, as the library has it: such texts are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store(path)
        whole, strings = tokenizer_of(path), special_strings(path)
        at = TaskContext.get().partitionId() << 40  # rows of the table of pieces are numbered
        for part in slices(batches, 1):
            ids, bounds = known.encode_texts(part.column(1))
            offsets, raw = text_bytes(part.column(1))
            data = raw.tobytes()
            hits = [m.start() for x in strings for m in re.finditer(re.escape(x), data)]
            marked = set((np.searchsorted(offsets, hits, "right") - 1).tolist())
            rows = []
            for i, (doc, a, b) in enumerate(zip(part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                own = ids[a:b] if i not in marked else whole.encode(part.column(1)[i].as_py(), add_special_tokens=False).ids
                own = np.append(own, end_id).astype("<u4")
                first = len(own) % most or most
                cuts = [0, *range(first, len(own) + 1, most)] if len(own) > most else [0, len(own)]
                for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append((doc, k, s, e - s, zlib.crc32(own[s:e].tobytes())))
            columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5
            columns.append(np.arange(at, at + len(rows)))
            at += len(rows)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE_SCHEMA)


def price(value: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over the lengths: (best value of each capacity, length taken at it or 0)."""
    best, take = np.zeros(most + 1), np.zeros(most + 1, np.int64)
    for c in range(1, most + 1):
        gains = best[c - 1 :: -1][:c] + value[1 : c + 1]
        k = int(gains.argmax())
        if gains[k] > best[c - 1]:
            best[c], take[c] = gains[k], k + 1
        else:
            best[c], take[c] = best[c - 1], 0
    return best, take


def configuration(take: np.ndarray, capacity: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while capacity > 0:
        length = int(take[capacity])
        if length:
            out[length] = out.get(length, 0) + 1
            capacity -= length
        else:
            capacity -= 1
    return out


def solve(histogram: dict[int, int], most: int = SEQUENCE, rounds: int = 600, eta: float = 4.0, width: int = 24):
    """Fractional cover of the histogram by configurations: [(configuration, times)].

    Multiplicative weights: a length's price falls by exp(-eta) per unit of its cover, relative to
    the pieces of it, and is nothing once all are covered. Every round prices configurations by one
    knapsack table; of the best one for each of several leading lengths, those within 0.5 % of
    the optimum are bought, each until the first of its lengths gains a bounded share of cover. The
    work depends on ``most`` and ``rounds`` alone, not on the number of pieces.
    """
    need = np.zeros(most + 1)
    for length, n in histogram.items():
        need[length] = n
    cover = np.zeros(most + 1)
    sizes = np.arange(most + 1) / most
    # long pieces fit fewer places, so their tokens are worth more at first
    weight = np.where(need > 0, sizes * (1 + sizes), 0.0)
    bought: dict[tuple, float] = {}
    for _ in range(rounds):
        short = np.maximum(need - cover, 0.0)
        if short.sum() < 1:
            break
        left = np.divide(cover, need, out=np.ones(most + 1), where=need > 0)
        value = np.where(short > 1e-9, weight * np.exp(-eta * left / 10), 0.0)
        best, take = price(value, most)
        if best[most] <= 0:
            break
        leads = np.flatnonzero(value > 0)
        total = value[leads] + best[most - leads]
        leads = leads[np.argsort(-total, kind="stable")][:width]
        for lead in leads.tolist():
            if value[lead] + best[most - lead] < 0.995 * best[most]:
                continue
            config = configuration(take, most - lead)
            config[lead] = config.get(lead, 0) + 1
            times = min((need[x] - cover[x]) / n for x, n in config.items())
            if times <= 0:
                continue
            share = max(0.25 * times, min(times, 1.0))
            for x, n in config.items():
                cover[x] += share * n
            key = tuple(sorted(config.items(), reverse=True))
            bought[key] = bought.get(key, 0.0) + share
    return list(bought.items())


def rounded(histogram: dict[int, int], solution: list, most: int = SEQUENCE) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, number of such sequences)], covering the histogram exactly.

    Configurations are taken as often as their share says, rounded down; what is left over goes, by
    falling length, to the fullest sequences with room for it, else to new ones. Sequences are
    handled in groups of equals, so the work follows the number of groups and not of pieces.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    groups: dict[tuple, int] = {}
    for config, times in sorted(solution, key=lambda s: (-s[1], s[0])):
        n = min([int(times + 1e-9), *(left.get(x, 0) // k for x, k in config)])
        if n > 0:
            key = tuple(x for x, k in config for _ in range(k))
            groups[key] = groups.get(key, 0) + n
            for x, k in config:
                left[x] -= k * n
    room: list[dict[tuple, int]] = [{} for _ in range(most + 1)]
    for key, n in groups.items():
        room[most - sum(key)][key] = n
    for x in sorted(left, reverse=True):
        n = left[x]
        while n:
            free = next((r for r in range(x, most + 1) if room[r]), None)
            if free is None:
                k = min(n, most // x)
                times = n // k
                room[most - k * x][(x,) * k] = room[most - k * x].get((x,) * k, 0) + times
                n -= k * times
                continue
            key, times = room[free].popitem()
            k = min(free // x, n)  # of one group of equals, first one piece each, or what fits
            used = min(times, n // k)
            if times > used:
                room[free][key] = times - used
            longer = key + (x,) * k
            room[free - k * x][longer] = room[free - k * x].get(longer, 0) + used
            n -= used * k
    return sorted(((list(key), n) for r in room for key, n in r.items() if key), reverse=True)


def pack(parts: DataFrame, most: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to pieces; sequences hold at most ``most`` ids, without gaps.

    The histogram has at most ``most`` rows, whatever the input; the LP is solved on it by the
    driver. Its groups of equal sequences name, for each length, intervals of ranks; every piece
    gets a rank among those of its length and finds its sequence by its rank. Ranks are counted in
    small salted groups and shifted by the totals of the groups before, which are summed in two
    levels, so that no task sees all pieces of a length. The salt is a hash of all columns: ``parts``
    should have one, such as ``row`` of :func:`pieces`, that tells equal pieces apart. Pieces longer than
    ``most`` or without length raise.
    """
    spark = parts.sparkSession
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(x is None or not 0 < x <= most for x in histogram):
        raise ValueError(f"pieces need a length from 1 to {most}")
    plan = rounded(histogram, solve(histogram, most), most)
    slots, sequence = [], 0
    ranks: dict[int, int] = {}
    for lengths, n in plan:
        at = 0
        for x in lengths:
            first = ranks.get(x, 0)
            slots.append((int(x), first, first + n, sequence - first, at))
            ranks[x] = first + n
            at += x
        sequence += n
    slot_schema = "length long, first long, until long, shift long, offset long"
    # at most a few thousand groups of at most `most` pieces each, so the table is small
    slot = F.broadcast(spark.createDataFrame(slots, slot_schema))
    counts = [(int(x), max(1, -(-n // RANK_ROWS))) for x, n in histogram.items()]
    salts = F.broadcast(spark.createDataFrame(counts, "length long, salts long"))
    key = F.pmod(F.xxhash64(*parts.columns), F.col("salts")).alias("salt")
    salted = parts.join(salts, "length").select(*parts.columns, key)
    group = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    group = group.withColumn("many", F.floor(F.col("salt") / RANK_SALTS))
    prior = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    large = group.groupBy("length", "many").agg(F.sum("n").alias("n"))
    large = large.select("length", "many", before(prior("length").orderBy("many")).alias("large_before"))
    group = group.withColumn("before", before(prior("length", "many").orderBy("salt"))).join(large, ["length", "many"])
    group = group.select("length", "salt", (F.col("before") + F.col("large_before")).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy(*[c for c in parts.columns if c != "length"])
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(group, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    found = ranked.join(
        slot.withColumnRenamed("length", "size"),
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until")),
    )
    return found.select(*parts.columns, (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    return pack(freeze(pieces(docs, path), "pieces")).drop("row")
