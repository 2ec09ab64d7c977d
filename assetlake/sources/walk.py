"""Folders walked breadth-first in tasks; the frontier of every depth is a table."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.session import cut

ENTRIES = "path string, length bigint, folder boolean"
ROWS = 10_000


def walk(
    spark: SparkSession,
    roots: str | list[str],
    glob: str | None = None,
    hidden: bool = False,
    missing_ok: bool = False,
    nested: bool = True,
) -> DataFrame:
    """(path, length) of the files below ``roots``; paths begin with the root as it is given.

    Every depth is one job whose tasks list a share of its folders, so no file passes through the driver. The
    listing is frozen depth by depth and does not change when a task is repeated. Names that begin with an
    underscore are left out, those that begin with a point and checksums unless ``hidden``, and files that
    do not match ``glob``. A root that is not there raises unless ``missing_ok``.
    """
    given = [r.rstrip("/") or "/" for r in ([roots] if isinstance(roots, str) else roots)]
    tops = {r: _info(r) for r in given}
    for root, info in tops.items():
        if info.type == pafs.FileType.NotFound and not missing_ok:
            raise FileNotFoundError(root)
    rows = [(r, i.size, i.type == pafs.FileType.Directory) for r, i in tops.items() if i.type != pafs.FileType.NotFound]
    level = spark.createDataFrame(rows, ENTRIES)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                fs, inner = pafs.FileSystem.from_uri(folder)
                # A folder that is gone by now has no files.
                found = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
                kept = [i for i in found if _wanted(i, glob, hidden)]
                for at in range(0, len(kept), ROWS):
                    some = kept[at : at + ROWS]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": [f"{folder.rstrip('/')}/{i.base_name}" for i in some],
                            "length": [i.size or 0 for i in some],
                            "folder": [i.type == pafs.FileType.Directory for i in some],
                        },
                        schema=pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())]),
                    )

    levels = [level]
    while not level.filter("folder").isEmpty():
        frontier = level.filter("folder").select("path").repartition(tasks, "path")
        level = cut(frontier.mapInArrow(children, ENTRIES))
        levels.append(level)
        if not nested:
            break
    files = reduce(DataFrame.unionByName, levels).filter(~F.col("folder"))
    return files.select("path", "length")


def _info(root: str) -> pafs.FileInfo:
    fs, inner = pafs.FileSystem.from_uri(root)
    return fs.get_file_info(inner)


def _wanted(info: pafs.FileInfo, glob: str | None, hidden: bool) -> bool:
    name = info.base_name
    if name.startswith("_") or (name.startswith(".") and (not hidden or name.endswith(".crc"))):
        return False
    return info.type == pafs.FileType.Directory or glob is None or fnmatchcase(name, glob)
