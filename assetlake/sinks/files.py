"""Named files written by tasks: payloads, documents, rowmaps, manifests."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.sources.bundles import list_files, n_tasks
from assetlake.sources.walk import walk


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(file, length) of the files below ``root``, named relative to it; empty if it is not there.

    Documents whose names begin with a point belong to an inventory, unfinished files below an underscore do not.
    """
    root = root.rstrip("/")
    files = walk(spark, root, hidden=True, missing_ok=True)
    return files.select(F.substr("path", F.lit(len(root) + 2)).alias("file"), "length")


def write_files(files: DataFrame, root: str, skip_existing: bool = False) -> tuple[int, int]:
    """Write ``content`` (text or binary) of each row to ``<root>/<file>``; (files, bytes) written.

    Each file appears under its name only when complete, so a repeated task does no harm. Existing
    files are looked up by the task that would write them; contents are not shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(root)
        n, total, last = 0, 0, None
        for batch in batches:
            targets = [f"{inner}/{name.as_py()}" for name in batch.column(0)]
            known = fs.get_file_info(targets) if skip_existing else [None] * len(targets)
            for i, (target, info) in enumerate(zip(targets, known, strict=True)):
                if info is not None and info.type == pafs.FileType.File:
                    continue
                content = batch.column(1)[i].as_py()
                data = content.encode() if isinstance(content, str) else content
                folder = target.rsplit("/", 1)[0]
                if folder != last:
                    fs.create_dir(folder, recursive=True)
                    last = folder
                part = f"{target}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(part) as out:
                    out.write(data)
                fs.move(part, target)
                n, total = n + 1, total + len(data)
        yield pa.RecordBatch.from_pydict({"n": [n], "bytes": [total]})

    done = files.select("file", "content").mapInArrow(run, "n bigint, bytes bigint")
    row = done.agg(F.sum("n"), F.sum("bytes")).first()
    return row[0] or 0, row[1] or 0


def rename_plan(spark: SparkSession, root: str, key: str = "bundle") -> DataFrame:
    """(path, target): the flat name ``<root>/<bundle>.parquet`` of every written bundle part."""
    name = F.regexp_extract("path", rf"/{key}=([^/]+)/", 1)
    files = list_files(spark, root, "*.parquet")
    return files.select("path", name.alias("name")).filter("name <> ''").select(
        "path", F.concat(F.lit(root.rstrip("/") + "/"), "name", F.lit(".parquet")).alias("target")
    )


def apply_renames(plan: DataFrame) -> int:
    """Move files to their targets in parallel; one that is already there is left alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = 0
            for path, target in zip(batch["path"], batch["target"], strict=True):
                fs, src = pafs.FileSystem.from_uri(path)
                _, dst = pafs.FileSystem.from_uri(target)
                if fs.get_file_info(src).type == pafs.FileType.File:
                    fs.move(src, dst)
                    n += 1
            yield pd.DataFrame({"n": [n]})

    spread = plan.repartition(n_tasks(plan.sparkSession), "path")
    return spread.mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0
