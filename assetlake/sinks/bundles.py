"""Parquet bundles: one row per material, one row per row group, payloads uncompressed."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import tier_px
from assetlake.functions.parquet import RowGroupWriter
from assetlake.operators import chunking as C
from assetlake.operators.ordered import largest_group, running
from assetlake.session import cut

#: Rows of a bundle table that is broadcast; at 1.8 GB a bundle that is 360 TB.
BROADCAST_ROWS = 200_000

#: Ranges of ids that a row is compared with on each level of a search.
FAN_OUT = 32

#: Payload bytes from which a bundle, or several small ones together, get a task of their own.
TASK_BYTES = 128 * 1024 * 1024

BUNDLE_OPTIONS = {
    "compression": "uncompressed",
    "parquet.block.row.count.limit": "1",
    **{f"parquet.enable.dictionary#{c}": "false" for c in S.CHANNELS},
}


def only_ok(df: DataFrame) -> DataFrame:
    """Rows whose status is ok (a missing status counts as ok)."""
    return df.filter(F.coalesce("status", F.lit("ok")) == "ok")


def bundle_projection(
    df: DataFrame, resolution_px: Column | int, baker_version: str, baked_at: str, *extra: str
) -> DataFrame:
    """Bundle columns of wide records; run constants are arguments, so a rerun gives equal rows."""
    px = F.lit(resolution_px) if isinstance(resolution_px, int) else resolution_px
    run = {
        "resolution_px": px.cast("int"),
        "baker_version": F.lit(baker_version),
        "baked_at": F.lit(baked_at),
    }
    have = df.columns
    defaults = {"source_url": F.lit(""), "source_license": F.lit("CC0-1.0")}
    out = []
    for f in S.BUNDLE_SCHEMA.fields:
        if f.name in run:
            col = run[f.name]
        elif f.name in have:
            col = F.coalesce(f.name, defaults[f.name]) if f.name in defaults else F.col(f.name)
        else:
            col = defaults.get(f.name, F.lit(None))
        out.append(col.cast(f.dataType).alias(f.name))
    return df.select(*out, *extra)


def _longest(value: str) -> list[Column]:
    """One payload per channel: the longest, of equally long ones the last by bytes."""
    rank = F.struct(F.length(value).alias("n"), F.col(value).alias("v"))
    return [F.max(F.when(F.col("channel") == c, rank))["v"].alias(c) for c in S.CHANNELS]


def _channel_columns(value: str) -> list[Column]:
    return [F.max(F.when(F.col("channel") == c, F.col(value))).alias(c) for c in S.CHANNELS]


def pivot_channels(textures: DataFrame, keys: list[str], value: str = "payload") -> DataFrame:
    """Long texture rows to one wide row per key; a channel without a row is null."""
    return textures.groupBy(*keys).agg(*_channel_columns(value))


def unpivot_channels(wide: DataFrame, keys: list[str], value: str = "payload") -> DataFrame:
    """Wide channel columns to long rows; a null channel gives no row."""
    channels = [c for c in S.CHANNELS if c in wide.columns]
    return wide.unpivot(keys, channels, "channel", value).filter(F.col(value).isNotNull())


def write_bundle(bundle: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write wide rows (status ok only) as they are partitioned; an empty input is an error."""
    rows = only_ok(bundle) if "status" in bundle.columns else bundle
    if rows.select("id").limit(1).count() == 0:
        raise ValueError("no successful records to write")
    rows.select(*[f.name for f in S.BUNDLE_SCHEMA.fields]).write.mode(mode).options(
        **BUNDLE_OPTIONS
    ).parquet(path)


def plan_bundles(
    textures: DataFrame,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    rotate: str = "count",
    prefix: str = S.ASSET_PREFIX,
    letters: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(chunks, bundles) of long texture rows, worked out on lengths alone.

    ``chunks`` has one row per material, ``bundles`` one per file with a dense ``bundle_no``. With
    ``letters`` groups beyond the limit are split by first letters, then rotated within these.
    """
    once = textures.groupBy(*C.GROUP, "id", "channel").agg(F.max("length").alias("length"))
    sizes = cut(C.material_sizes(once))
    group = C.GROUP
    if letters:
        sizes, group = cut(C.split_by_letters(sizes, max_bytes=max_bytes)), [*C.GROUP, "letters"]
    if rotate == "count":
        chunks = C.chunk_by_count(sizes, group, max_bytes=max_bytes)
    else:
        chunks = C.chunk_by_bytes(sizes, group, max_bytes=max_bytes)
    chunks = cut(chunks)
    files = C.bundle_files(C.chunk_bounds(chunks), prefix, first_unnumbered=rotate != "count")
    return chunks, cut(numbered(files))


def numbered(files: DataFrame) -> DataFrame:
    """``files`` with a dense ``bundle_no`` in the order of their names."""
    rows = running(files.withColumn("_all", F.lit(1)), ["_all"], ["parquet_file"])
    return rows.withColumn("bundle_no", (F.col("rn") - 1).cast("int")).drop("_all", "rn", "n")


def with_bundle(rows: DataFrame, chunks: DataFrame, bundles: DataFrame) -> DataFrame:
    """Rows (group, id, …) with the ``parquet_file`` and ``bundle_no`` they belong to.

    A bundle is a range of ids of its group, so a bundle table whose size was checked is broadcast
    and payload rows are not shuffled for it; beyond that the assignment is joined by id. Both give
    the same rows.
    """
    named = ["parquet_file", "bundle_no"]
    more = ["letters"] if "letters" in bundles.columns else []
    if bundles.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ranges = bundles.select(*C.GROUP, *more, "first_id", "last_id", *named)
        if not more:
            return _in_ranges(rows, ranges, C.GROUP, named)
        # ids of other first letters may lie between those of a range
        spans = cut(ranges.select(*[F.col(k).alias(f"_{k}") for k in C.GROUP], F.col("letters").alias("_letters")).distinct())
        low, high = F.substring("_letters", 1, 1), F.substring("_letters", 3, 1)
        letter = C.letter_of("id")
        lettered = F.coalesce((letter == low) | ((letter > low) & (letter <= high) & (low >= "A")), F.lit(True))
        spanned = rows.join(F.broadcast(spans), [*[F.col(k) == F.col(f"_{k}") for k in C.GROUP], lettered])
        spanned = spanned.select(*rows.columns, "_letters")
        found = _in_ranges(spanned, ranges.withColumnRenamed("letters", "_letters"), [*C.GROUP, "_letters"], named)
        return found.drop("_letters")
    places = bundles.select(*[F.col(c).alias(f"_{c}") for c in (*C.GROUP, "chunk", *more)], *named)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*C.GROUP, "chunk", *more)]
    by_id = chunks.join(places, same)
    return rows.join(by_id.select(*C.GROUP, "id", *named), [*C.GROUP, "id"])


def _in_ranges(rows: DataFrame, ranges: DataFrame, keys: list[str], found: list[str]) -> DataFrame:
    """``rows`` with the columns ``found`` of the range (keys, first_id, last_id) that their id lies in.

    The ranges of a key do not overlap; null keys match only beyond those of the group. Ranges are the leaves of a
    tree, which rows descend by broadcast joins: a row is compared with ``FAN_OUT`` ranges of every level, not with
    all of its key.
    """
    levels, largest = 1, largest_group(ranges, keys)
    while FAN_OUT**levels < largest:
        levels += 1
    if levels > 1:
        ranges = cut(running(ranges, keys, ["first_id"], largest=largest).withColumn("_at", F.col("rn") - 1).drop("rn", "n"))
    for level in reversed(range(levels)):
        nodes, up, down = ranges, [], found
        if levels > 1:
            nodes = nodes.withColumn("_node", F.floor(F.col("_at") / FAN_OUT**level))
        if level:
            nodes = nodes.groupBy(*keys, "_node").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
            nodes, down = cut(nodes), ["_node"]
        if level < levels - 1:
            nodes = nodes.withColumn("_parent", F.floor(F.col("_node") / FAN_OUT))
            up = [F.col("r._node") == F.col("b._parent")]
        same = [F.col(f"r.{k}") == F.col(f"b.{k}") if k in C.GROUP else F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        inside = F.col("r.id").between(F.col("b.first_id"), F.col("b.last_id"))
        joined = rows.alias("r").join(F.broadcast(nodes.alias("b")), [*same, *up, inside])
        rows = joined.select(*[f"r.{c}" for c in rows.columns if c != "_node"], *[f"b.{c}" for c in down])
    return rows


def write_partitioned_bundle(
    textures: DataFrame,
    records: DataFrame,
    path: str,
    baker_version: str,
    baked_at: str,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    rotate: str = "count",
    prefix: str = S.ASSET_PREFIX,
    mode: str = "errorifexists",
    planned: DataFrame | None = None,
    letters: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Write long texture rows as size-bounded bundles; returns (chunks, bundles).

    ``textures``: (source, tier, category, id, channel, payload, length); ``records``: (source, id,
    source_url, source_license); ``planned``: the textures without payload that are to be written,
    all of them by default. Files are ``<path>/bundle=<name>/…``, rows sorted by id.

    Payloads are shuffled once, to the task that writes their file. The metadata of a material
    travels as one more row, and only materials that have such a row are written. Of a channel that
    a material has twice, the longest payload is written. ``letters`` names the files of groups beyond
    the limit by ranges of first letters.
    """
    planned = textures.drop("payload") if planned is None else planned
    chunks, bundles = plan_bundles(planned, max_bytes, rotate, prefix, letters)
    n_bundles, n_bytes = bundles.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    if n_bundles == 0:
        raise ValueError("no successful records to write")
    meta = chunks.select(*C.GROUP, "id").join(
        records.select("source", "id", "source_url", "source_license"), ["source", "id"], "left"
    )
    rows = with_bundle(
        textures.select(*C.GROUP, "id", "channel", "payload").unionByName(
            meta.withColumn("planned", F.lit(True)), allowMissingColumns=True
        ),
        chunks,
        bundles,
    )
    n_tasks = write_tasks(rows.sparkSession, n_bundles, n_bytes)
    write_rows(rows, n_tasks, path, baker_version, baked_at, mode)
    return chunks, bundles


def write_tasks(spark: SparkSession, n_bundles: int, n_bytes: int | None) -> int:
    """Tasks that write so many bundles: one each where they are large, else each writes several.

    Small bundles would otherwise be as many tasks as files, each with its block in every map output.
    """
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(n_bytes or 0) // TASK_BYTES))
    return max(1, min(n_bundles, wanted))


def write_rows(
    rows: DataFrame, n_tasks: int, path: str, baker_version: str, baked_at: str, mode: str
) -> None:
    """Write rows (group, id, channel, payload, source_url, source_license, planned, parquet_file,
    bundle_no) as one file per bundle, sorted by id; materials without a planned row are left out.

    A bundle is written by one of ``n_tasks`` tasks.
    """
    stem = F.regexp_replace("parquet_file", r"\.parquet$", "").alias("bundle")
    wide = (
        rows.select(stem, F.pmod("bundle_no", F.lit(n_tasks)).cast("int").alias("_task"), *rows.columns)
        .repartitionById(n_tasks, "_task")  # one task per file
        .groupBy("bundle", "id", "_task", *C.GROUP)
        .agg(
            *_longest("payload"),
            F.max("source_url").alias("source_url"),
            F.max("source_license").alias("source_license"),
            F.max("planned").alias("planned"),
        )
        .filter("planned")
    )
    px = F.coalesce(tier_px("tier"), F.lit(0))
    out = bundle_projection(wide, px, baker_version, baked_at, "bundle").sortWithinPartitions("bundle", "id")
    write_sorted(out, path, mode)


def write_sorted(bundles: DataFrame, path: str, mode: str) -> None:
    """Write wide rows, sorted by ``bundle`` and all rows of a bundle in one partition, as ``bundle=<name>/<file>``.

    Spark's own writer keeps values and entries of every row group until a file is closed, so the memory of a task
    would grow with its bundle. Files appear under their name only when complete, ``_SUCCESS`` when all are there.
    """
    fs, inner = pafs.FileSystem.from_uri(path)
    if mode == "ignore" and fs.get_file_info(inner).type != pafs.FileType.NotFound:
        return
    spark = bundles.sparkSession
    # Makes or clears the folder, or refuses to, as ``mode`` says.
    empty = spark.createDataFrame([], bundles.schema).write.mode(mode).partitionBy("bundle")
    empty.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    fields = S.BUNDLE_SCHEMA.fields
    names, file = [f.name for f in fields], f"part-{uuid.uuid4().hex}.parquet"
    about = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": S.BUNDLE_SCHEMA.json()}
    ranked = set(names) - set(S.CHANNELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        bundle = out = writer = folder = part = None
        n = 0

        def finish():
            writer.close()
            out.close()
            fs.move(part, f"{folder}/{file}")

        try:
            for batch in batches:
                columns = [batch.column("bundle"), *(batch.column(c) for c in names)]
                for i in range(batch.num_rows):
                    stem, *row = (c[i].as_py() for c in columns)
                    if writer is None or stem != bundle:
                        if writer is not None:
                            finish()
                        bundle, folder = stem, f"{root}/bundle={folder_name(stem)}"
                        fs.create_dir(folder, recursive=True)
                        part = f"{folder}/_{uuid.uuid4().hex}"
                        out = fs.open_output_stream(part)
                        writer = RowGroupWriter(out, S.BUNDLE_SCHEMA, ranked, about)
                    writer.write(row)
                    n += 1
            if writer is not None:
                finish()
        except BaseException:
            if writer is not None:
                writer.discard()
                out.close()
                if fs.get_file_info(part).type == pafs.FileType.File:
                    fs.delete_file(part)
            raise
        yield pa.RecordBatch.from_pydict({"n": [n]})

    try:
        bundles.select("bundle", *names).mapInArrow(run, "n bigint").agg(F.sum("n")).first()
    except BaseException:
        if mode != "append":
            fs.delete_dir_contents(inner, missing_dir_ok=True)
        raise
    fs.open_output_stream(f"{inner}/_SUCCESS").close()


def folder_name(value: str | None) -> str:
    """``value`` as Spark writes it into the name of a partition's folder."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)
