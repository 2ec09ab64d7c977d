"""Bundles, archives, texture trees, documents and byte ranges of files.

File bytes are opened by path inside the tasks, so only the bytes that are needed are read and
nothing large passes from the JVM to a Python worker.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

from assetlake import schemas as S
from assetlake.functions.names import material_id_of_document
from assetlake.functions.parquet import footer_portions
from assetlake.functions.payload import length_ok, size
from assetlake.sources.walk import walk

Paths = str | list[str]
SLAB = 256 * 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024
#: Rows about archives and footers that leave a task together.
FRAME_ROWS = 10_000


def open_path(path: str):
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def record_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows that carry a payload, closed after so many payload bytes."""
    at = schema.get_field_index("payload")
    pending, size = [], 0
    for row in rows:
        pending.append(row)
        size += len(row[at] or b"")
        if size >= BATCH_BYTES:
            yield _record_batch(pending, schema)
            pending, size = [], 0
    if pending:
        yield _record_batch(pending, schema)


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def n_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def list_files(spark: SparkSession, paths: Paths, glob: str | None = None, nested: bool = True) -> DataFrame:
    """(path, length) of files with content below the given folders; contents are not read.

    Folders are listed by tasks. Patterns among ``paths``, and a ``glob`` that is more than an ending, are left
    to Spark's file index.
    """
    end = (glob or "*").removeprefix("*")
    if not any(c in p for p in [end, *([paths] if isinstance(paths, str) else paths)] for c in "*?[{"):
        files = walk(spark, paths, glob, nested=nested).filter("length > 0")
        return files.filter(F.endswith("path", F.lit(end)))  # a file among the paths is not listed by its folder
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(nested).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", "length")


def read_bundle(spark: SparkSession, paths: Paths, channels: list[str] | None = None) -> DataFrame:
    """Texture bundles; without named channels only the scalar columns are scanned."""
    scalars = [f.name for f in S.BUNDLE_SCHEMA.fields if f.name not in S.CHANNELS]
    reader = spark.read.schema(S.BUNDLE_SCHEMA).option("recursiveFileLookup", "true")
    return reader.parquet(*([paths] if isinstance(paths, str) else paths)).select(
        *scalars, *(channels or [])
    )


def file_contents(files: DataFrame) -> DataFrame:
    """(path, payload, length) of files, opened by the tasks; small files share tasks."""
    arrow = pa.schema([("path", pa.string()), ("payload", pa.binary()), ("length", pa.int64())])

    def contents(paths: Iterator[str]) -> Iterator[tuple]:
        for name in paths:
            with open_path(name) as fh:
                data = fh.read()
            yield name, data, len(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return record_batches(contents(p for b in batches for p in b.column(0).to_pylist()), arrow)

    return _spread(files.select("path")).mapInArrow(run, "path string, payload binary, length bigint")


def read_texture_tree(spark: SparkSession, path: Paths, glob: str = "*.png") -> DataFrame:
    """``<id>/<channel>.png`` files as (id, channel, payload, length); folders are listed and files read by tasks."""
    parts = F.split("path", "/")
    return file_contents(walk(spark, path, glob)).select(
        F.element_at(parts, -2).alias("id"),
        F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("channel"),
        "payload",
        "length",
    )


def read_documents(spark: SparkSession, path: Paths) -> DataFrame:
    """(id, path, xml) of every ``.mtlx`` file."""
    return file_contents(list_files(spark, path, "*.mtlx")).select(
        material_id_of_document(F.col("path")).alias("id"), "path", F.col("payload").cast("string").alias("xml")
    )


MEMBER_SCHEMA = (
    "archive string, member_no int, member string, size bigint, compressed bigint, error string"
)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["archive", "member_no", "member", "size", "compressed", "error"]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path in batch["path"]:
                try:
                    with open_path(path) as fh, zipfile.ZipFile(fh) as zf:
                        infos = zf.infolist()
                except Exception as exc:  # one unreadable archive must not fail the others
                    yield path, None, None, None, None, f"{type(exc).__name__}: {exc}"
                    continue
                for i, m in enumerate(infos):
                    yield path, i, m.filename, m.file_size, m.compress_size, None

    for some in _slices(rows()):
        yield pd.DataFrame(some, columns=cols).astype(object)


def _slices(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows of many files in one frame, those of a large file in several."""
    while some := list(islice(rows, FRAME_ROWS)):
        yield some


def _spread(files: DataFrame, *keys: str) -> DataFrame:
    return files.repartition(n_tasks(files.sparkSession), *(keys or ("path",)))


def archive_members(files: DataFrame) -> DataFrame:
    """One row per member of each ZIP, from its directory only; unreadable ones give an error."""
    return _spread(files.select("path")).mapInPandas(_members, MEMBER_SCHEMA)


def read_members(members: DataFrame) -> DataFrame:
    """``members`` (archive, member_no, …) plus their payload.

    All columns travel along, so nothing has to be joined to payload rows afterwards. Pass only
    members of archives that were found safe.
    """
    schema = StructType([*members.schema.fields, StructField("payload", BinaryType())])
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        path = fh = zf = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != path:
                    if fh:
                        fh.close()
                    path = row["archive"]
                    fh = open_path(path)
                    zf = zipfile.ZipFile(fh)
                    infos = zf.infolist()
                yield (*row.values(), zf.read(infos[row["member_no"]]))

    # not by the archive itself: rows that lie so already would be left in few tasks, as they are small
    spread = members.repartition(n_tasks(members.sparkSession), F.xxhash64("archive"))
    return spread.sortWithinPartitions("archive", "member_no").mapInArrow(
        lambda batches: record_batches(rows(batches), arrow), schema
    )


def read_archives(spark: SparkSession, path: Paths) -> DataFrame:
    return archive_members(list_files(spark, path, "*.zip"))


FOOTER_SCHEMA = (
    "path string, parquet_file string, n_row_groups int, row_idx int, column string, "
    "num_values bigint, null_count bigint, codec string, chunk_start bigint, chunk_size bigint, "
    "row_id string"
)


def footers(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per row group and column of each Parquet file, from the footers alone.

    ``row_id`` is the id of the row group by its statistics, null where there are none. An empty
    file gives one row without a column. Large footers are read in portions, whatever their number of row groups.
    """
    wanted = set(columns or S.CHANNELS)
    names = [c.split()[0] for c in FOOTER_SCHEMA.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for path in batch["path"]:
                some = False
                with open_path(path) as fh:
                    file = path.rsplit("/", 1)[-1]
                    for n, first, meta in footer_portions(fh):
                        for g in range(meta.num_row_groups):
                            group = meta.row_group(g)
                            columns_ = [group.column(c) for c in range(group.num_columns)]
                            ids = [c.statistics for c in columns_ if c.path_in_schema == "id"]
                            row_id = ids[0].min if ids and ids[0] and ids[0].has_min_max else None
                            for col in columns_:
                                if col.path_in_schema not in wanted:
                                    continue
                                start = col.dictionary_page_offset or col.data_page_offset
                                length = col.total_compressed_size
                                nulls = col.statistics.null_count if col.is_stats_set else None
                                some = True
                                yield (
                                    path, file, n, first + g, col.path_in_schema, col.num_values, nulls,
                                    col.compression, start, length, row_id,
                                )
                if not some:
                    yield path, file, n, *[None] * (len(names) - 3)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _slices(rows(batches)):
            yield pd.DataFrame(some, columns=names).astype(object)

    return _spread(files.select("path")).mapInPandas(run, FOOTER_SCHEMA)


RANGE_KEYS = ["source", "tier", "id", "channel"]


def located_ranges(requests: DataFrame, rowmap: DataFrame) -> DataFrame:
    """Distinct requests with their (parquet_file, offset, length), null where the rowmap has none.

    Rows of the rowmap meet requests by material, and channels are matched within it, so a rowmap in buckets of
    (source, tier, id) is read as it lies.
    """
    keys = RANGE_KEYS[:3]
    wanted = requests.select(*RANGE_KEYS).distinct()
    place = F.struct("channel", "parquet_file", "offset", "length")
    held = rowmap.join(requests.select(*keys).distinct(), keys, "left_semi").groupBy(*keys)
    held = held.agg(F.collect_list(place).alias("places"))
    own = F.filter("places", lambda p: p["channel"] == F.col("channel"))
    found = wanted.join(held, keys, "left").select(*RANGE_KEYS, F.explode_outer(own).alias("p"))
    return found.select(*RANGE_KEYS, "p.parquet_file", "p.offset", "p.length")


def fetch_ranges(
    requests: DataFrame,
    rowmap: DataFrame,
    files: DataFrame,
    cap: int = S.MAX_FETCH_BYTES,
    magics: tuple[bytes, ...] = (S.PNG_MAGIC,),
) -> DataFrame:
    """Payload of every requested (source, tier, id, channel), each range read once.

    ``files`` maps ``parquet_file`` to ``path``. Reads are grouped by slabs of a file and sorted
    by offset, so a much-requested file is spread over tasks. Problems come as ``error_kind``.
    """
    spark = requests.sparkSession
    located = located_ranges(requests, rowmap).join(files.select("parquet_file", "path"), "parquet_file", "left")
    error = (
        F.when(F.col("offset").isNull(), "not_in_rowmap")
        .when(~length_ok("length", cap), "bad_length")
        .when(F.col("path").isNull(), "no_file")
    )
    plan = located.withColumn("error_kind", error).withColumn(
        "slab", F.floor(F.col("offset") / SLAB)
    )
    schema = (
        "source string, tier string, id string, channel string, parquet_file string, "
        "offset bigint, length bigint, error_kind string, payload binary"
    )
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names = arrow.names[:-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        path = fh = None
        for batch in batches:
            for row in batch.to_pylist():
                data = None
                if row["error_kind"] is None:
                    if row["path"] != path:
                        if fh:
                            fh.close()
                        path = row["path"]
                        fh = open_path(path)
                    fh.seek(row["offset"])
                    data = fh.read(row["length"])
                    if len(data) != row["length"]:
                        row["error_kind"], data = "short_read", None
                    elif magics and not data.startswith(magics):
                        row["error_kind"], data = "bad_magic", None
                yield (*[row[n] for n in names], data)

    # Rows that need no read have no slab; they spread over the tasks by their id.
    spread = F.coalesce("slab", F.pmod(F.hash("id"), F.lit(1024)).cast("long"))
    return (
        plan.repartition(n_tasks(spark), F.col("path"), spread)
        .sortWithinPartitions("path", "offset")
        .mapInArrow(lambda batches: record_batches(rows(batches), arrow), schema)
    )


def bundle_payloads(bundle: DataFrame) -> DataFrame:
    """Long rows (source, id, category, channel, payload, length) of wide bundle rows."""
    textures = F.filter(
        F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("payload"))
                  for c in S.CHANNELS]),
        lambda t: t["payload"].isNotNull(),
    )
    keep = [c for c in bundle.columns if c not in S.CHANNELS]
    return (
        bundle.select(*keep, F.explode(textures).alias("t"))
        .select(*keep, "t.channel", "t.payload")
        .withColumn("length", size("payload"))
    )
