"""Helpers the operators share: frozen tables, text as bytes, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.session import prepare as prepare
from assetlake.session import run_dir

#: Texts a writing task holds before it writes a row group.
ROW_GROUP = 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Costly or random results are frozen so that a lost executor can never change them. Shuffle
    files of the write are given up as soon as it is complete; nobody reads them again.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, prolonged until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column, null as empty, without copying the bytes."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and the heap keeps what they freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold about ``most`` bytes, or one row.

    Memory that earlier tasks of the worker, and this one, have freed is given back.
    """
    give_back()
    for batch in batches:
        offsets, _ = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    give_back()


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    out = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return out + np.arange(total, dtype=np.int64)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Root of each of ``n`` nodes under the given links: the smallest node of its component."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        differ = a != b
        if not differ.any():
            break
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    Every round hooks each node to its smallest neighbour, shortens the pointers by doubling and
    contracts the links to what they point at, all by joins and map-side combined minima; nothing
    is gathered on the driver but the count that ends a loop. Rounds are frozen by checkpoint().
    """
    spark = links.sparkSession
    run_dir(spark, "components")  # sets the checkpoint folder
    both = links.select(F.least(left, right).alias("lo"), F.greatest(left, right).alias("hi"))
    edges = both.where("lo < hi").distinct().checkpoint()
    labels = (
        edges.select(F.col("lo").alias("node")).union(edges.select("hi")).distinct()
        .select("node", F.col("node").alias("component")).checkpoint()
    )
    while not edges.isEmpty():
        point = edges.groupBy(F.col("hi").alias("child")).agg(F.min("lo").alias("parent")).checkpoint()
        while True:
            up = point.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            longer = point.join(up, "parent", "left").select(
                "child", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            ).checkpoint()
            point = longer.select("child", "parent")
            if longer.where("moved").isEmpty():
                break

        def follow(df: DataFrame, column: str, to: DataFrame = point) -> DataFrame:
            to = to.select(F.col("child").alias(column), F.col("parent").alias("to"))
            return df.join(to, column, "left").withColumn(column, F.coalesce("to", column)).drop("to")

        labels = follow(labels, "component").checkpoint()
        edges = follow(follow(edges, "lo"), "hi")
        edges = (
            edges.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
            .where("lo < hi").distinct().checkpoint()
        )
    return labels
