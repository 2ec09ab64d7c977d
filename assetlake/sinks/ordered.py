"""Documents of any size, put together in order from pieces.

A document is a head, pieces in the order of their keys with a separator between them, and a tail. Sums of the
pieces' lengths give every piece its place, so tasks write parts of bounded size wherever they run; a
document of several parts is then joined by one task that copies them in blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.operators.ordered import running
from assetlake.sinks.files import write_files

PART_BYTES = 8 * 1024 * 1024
COPY_BYTES = 1024 * 1024


def ordered_parts(pieces: DataFrame, frames: DataFrame, part_bytes: int = PART_BYTES, separator: str = ",") -> DataFrame:
    """(file, start, alone, content): documents in parts of ``part_bytes`` or one piece more.

    ``pieces``: (file, key, piece) with unique, non-null keys; ``frames``: (file, head, tail), one row per document,
    also for those without pieces. ``start`` is the place of the part in bytes, ``alone`` marks the part of a
    document that has no other. Parts in order of ``start`` are the document. Pieces of a file without frame
    are left out.
    """
    gap = len(separator.encode())
    sized = pieces.select("file", "key", "piece", (F.octet_length("piece") + gap).cast("long").alias("_bytes"))
    # A document may be most of the rows or bytes, so the rows are always cut into ranges.
    placed = running(sized, ["file"], ["key"], sums={"_before": "_bytes"}, max_window_rows=0, largest=1)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("key", "piece"))), lambda p: p["piece"])
    parts = placed.groupBy("file", F.floor(F.col("_before") / part_bytes).alias("_part")).agg(
        F.min("_before").alias("_start"),
        F.max(F.col("rn") == 1).alias("_first"),
        F.max(F.col("rn") == F.col("n")).alias("_last"),
        F.array_join(texts, separator).alias("_text"),
    )
    framed = frames.select("file", "head", "tail").join(parts, "file", "left")
    first, last = F.coalesce("_first", F.lit(True)), F.coalesce("_last", F.lit(True))
    content = F.concat(
        F.when(first, F.col("head")).otherwise(""),
        F.coalesce("_text", F.lit("")),
        F.when(last, F.col("tail")).otherwise(separator),
    )
    start = F.when(first, F.lit(0)).otherwise(F.octet_length("head") + F.col("_start"))
    return framed.select("file", start.cast("long").alias("start"), (first & last).alias("alone"), content.alias("content"))


def write_ordered(parts: DataFrame, root: str) -> tuple[int, int]:
    """Write the documents of ``ordered_parts`` to ``<root>/<file>``; (files, bytes) written.

    A document appears under its name only when complete, so a repeated task does no harm. The parts of larger ones
    lie in a folder of their own, which readers of ``root`` pass over, until all documents are there.
    """
    scratch = f"_parts-{uuid.uuid4().hex}"
    place = F.concat(F.lit(f"{scratch}/"), "file", F.lit("/"), F.lpad(F.col("start").cast("string"), 20, "0"))
    named = parts.withColumn("name", F.when(F.col("alone"), F.col("file")).otherwise(place))
    n_parts, n_bytes = write_files(named.select(F.col("name").alias("file"), "content"), root)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = pafs.FileSystem.from_uri(root)
        files = joined = 0
        for batch in batches:
            for file, entries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                target = f"{inner}/{file}"
                fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                unfinished = f"{target}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(unfinished) as out:
                    for e in entries:
                        if out.tell() != e["start"]:
                            raise ValueError(f"{file}: a part that starts at {e['start']} would stand at {out.tell()}")
                        with fs.open_input_stream(f"{inner}/{e['name']}") as part:
                            while block := part.read(COPY_BYTES):
                                out.write(block)
                fs.move(unfinished, target)
                files, joined = files + 1, joined + len(entries)
        yield pa.RecordBatch.from_pydict({"files": [files], "parts": [joined]})

    # Without ``content`` these rows are aggregates of the checkpointed places; no text is read for them.
    several = named.filter(~F.col("alone")).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "name"))))
    done = several.mapInArrow(compose, "files bigint, parts bigint").agg(F.sum("files"), F.sum("parts")).first()
    files, joined = done[0] or 0, done[1] or 0
    if joined:
        fs, inner = pafs.FileSystem.from_uri(root)
        fs.delete_dir(f"{inner}/{scratch}")
    return n_parts - joined + files, n_bytes
