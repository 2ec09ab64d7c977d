"""Token counts of flat token files: a scan for separators, stitched by a prefix scan over blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetlake.llm.bpe import store
from assetlake.llm.common import freeze, slices
from assetlake.session import run_dir

SEPARATOR = 50256
#: Ids read at once by a task, and blocks of a file whose totals are summed in one window.
BLOCK = 1 << 20
SUPER = 1024
DTYPE = np.dtype("<u2")


def write_token_files(docs: DataFrame, root: str, path: str, separator: int = SEPARATOR) -> DataFrame:
    """One flat file per task below ``root``: ids as two little-endian bytes, ``separator`` after each text.

    The files hold nothing else. Returned, frozen: (file, ordinal, doc_id), the order of the texts
    in each file. A file appears under its name only when complete; a repeated task replaces it by
    the same bytes. Null texts count as empty. An id that is the separator or takes more than two bytes
    raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = store(path)
        fs, inner = pafs.FileSystem.from_uri(root)
        fs.create_dir(inner, recursive=True)
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        part = f"{inner}/_{name}.{uuid.uuid4().hex}"
        at = 0
        with fs.open_output_stream(part) as out:
            for piece in slices(batches, 1, 1 << 19):
                ids, bounds = known.encode_texts(piece.column(1))
                if len(ids) and (ids.max() > np.iinfo(DTYPE).max or (ids == separator).any()):
                    raise ValueError(f"this vocabulary has ids above {np.iinfo(DTYPE).max} or the separator {separator} as an id")
                out.write(np.insert(ids.astype(DTYPE), bounds[1:], separator).astype(DTYPE).tobytes())
                n = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(at, at + n)), piece.column(0)],
                    ["file", "ordinal", "doc_id"],
                )
                at += n
        if at:
            fs.move(part, f"{inner}/{name}")
        else:
            fs.delete_file(part)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return freeze(rows.mapInArrow(run, "file string, ordinal bigint, doc_id bigint"), "token-order")


def file_lengths(spark: SparkSession, root: str, names: DataFrame) -> DataFrame:
    """(file, n) with the ids of each file, looked up by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(root)
        for batch in batches:
            infos = fs.get_file_info([f"{inner}/{x}" for x in batch.column(0).to_pylist()])
            n = pa.array([i.size // DTYPE.itemsize for i in infos], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], ["file", "n"])

    return names.select("file").distinct().mapInArrow(run, "file string, n bigint")


def scan(spark: SparkSession, root: str, files: DataFrame, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """(file, ordinal, n_tokens) of every text in flat token files, the separators not counted.

    Blocks are read and searched independently. A block tells the lengths between its own
    separators, the ids before its first and after its last one. Prefix sums over the blocks of a
    file then give each block the number of texts before it and the open length carried into it; a
    block without separator adds all its ids to what is carried. Ids after the last separator of a
    file are no text and not counted; neither is an empty file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for name, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{inner}/{name}") as f:
                    ids = np.frombuffer(f.read_at(n * DTYPE.itemsize, at * DTYPE.itemsize), DTYPE)
                ends = np.flatnonzero(ids == separator)
                head = int(ends[0]) if len(ends) else len(ids)
                tail = len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids)
                row = {
                    "file": [name], "block": [at // block], "n_ends": [len(ends)], "head": [head], "tail": [tail],
                    "inner": pa.array([np.diff(ends) - 1], pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_pydict(row)

    tasks = files.where("n > 0").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block).cast("long"))).alias("at"), "n"
    ).select("file", "at", F.least(F.lit(block), F.col("n") - F.col("at")).alias("n"))
    schema = "file string, block bigint, n_ends bigint, head bigint, tail bigint, inner array<bigint>"
    spread = tasks.repartition(F.col("file"), F.col("at"))
    blocks = freeze(spread.mapInArrow(run, schema), "token-blocks")
    sums = stitched(blocks.drop("inner"))
    with_sums = blocks.join(sums, ["file", "block"])
    lengths = F.when(
        F.col("n_ends") > 0, F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner"))
    ).otherwise(F.array().cast("array<bigint>"))
    out = with_sums.select("file", "texts_before", F.posexplode(lengths).alias("k", "n_tokens"))
    return out.select("file", (F.col("texts_before") + F.col("k")).alias("ordinal"), "n_tokens")


def stitched(blocks: DataFrame) -> DataFrame:
    """(file, block, texts_before, carried): exclusive prefix scan over the blocks of each file.

    (ends, open) of two neighbours join to (ends + ends', open' if ends' else open + open'). The
    scan runs inside groups of blocks, then over the groups' totals, so no window holds all blocks
    of a long file.
    """
    blocks = blocks.withColumn("group", F.floor(F.col("block") / SUPER))
    inside = exclusive_scan(blocks, ["file", "group"], "block", "n_ends", "tail")
    totals = blocks.groupBy("file", "group").agg(
        F.sum("n_ends").alias("n_ends"),
        F.max("block").alias("last"),
        F.max(F.when(F.col("n_ends") > 0, F.struct("block", "tail"))).alias("end"),
        F.collect_list(F.struct("block", "tail")).alias("all"),  # at most SUPER small pairs
    )
    after = F.filter("all", lambda x: F.col("end").isNull() | (x["block"] > F.col("end")["block"]))
    open_after = F.aggregate(after, F.lit(0).cast("long"), lambda acc, x: acc + x["tail"])
    totals = totals.select(
        "file", "group", "n_ends", (open_after + F.coalesce(F.col("end")["tail"], F.lit(0))).alias("tail")
    )
    groups = exclusive_scan(totals, ["file"], "group", "n_ends", "tail").select(
        "file", "group", F.col("ends").alias("group_ends"), F.col("open").alias("group_open")
    )
    carried = F.col("open") + F.when(F.col("ends") == 0, F.col("group_open")).otherwise(0)
    return inside.join(groups, ["file", "group"]).select(
        "file", "block", (F.col("ends") + F.col("group_ends")).alias("texts_before"), carried.alias("carried")
    )


def exclusive_scan(rows: DataFrame, by: list[str], at: str, ends: str, tail: str) -> DataFrame:
    """Add ``ends`` and ``open`` of all rows before: separators, and ids since the last of them.

    The running sum of the tails, less the sum there was before the last row with a separator.
    """
    upto = Window.partitionBy(*by).orderBy(at)
    rows = rows.withColumn("sum_before", F.sum(tail).over(upto) - F.col(tail))
    prior = upto.rowsBetween(Window.unboundedPreceding, -1)
    reset = F.coalesce(F.max(F.when(F.col(ends) > 0, F.col("sum_before"))).over(prior), F.lit(0))
    return rows.select(
        *by, at, F.coalesce(F.sum(ends).over(prior), F.lit(0)).alias("ends"), (F.col("sum_before") - reset).alias("open")
    )


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens): write the flat files, scan them, and name the texts by their order."""
    spark = docs.sparkSession
    root = run_dir(spark, "tokens")
    order = write_token_files(docs, root, path)
    counts = scan(spark, root, file_lengths(spark, root, order))
    return order.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
