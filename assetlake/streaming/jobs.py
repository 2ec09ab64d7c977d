"""Resumable and continuous ingestion with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from assetlake import schemas as S
from assetlake.operators.chunking import GROUP, bundle_files, chunk_by_bytes
from assetlake.plans.derive import rowmap_of_placed
from assetlake.session import keep
from assetlake.sinks.bundles import numbered, write_rows, write_tasks
from assetlake.sources.bundles import list_files

BATCH_FILES = 50


def exists(path: str) -> bool:
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = BATCH_FILES,
    glob: str | None = None,
) -> DataFrame:
    """Stream of landed files in bounded batches."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def bake_stream(
    stream: DataFrame,
    bake_batch: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Bake every batch into ``<path>/batch=<n>``; stops when all landed files are done.

    The checkpoint resumes a broken run, and a batch that is repeated overwrites itself.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        bake_batch(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress(spark: SparkSession, path: str, keys: tuple[str, ...] = ("source", "tier")):
    """(keys, batches, offset_done) from the batches a bake stream has written."""
    return spark.read.parquet(path).groupBy(*keys).agg(
        F.countDistinct("batch").alias("batches"), F.count(F.lit(1)).alias("offset_done")
    )


def resume_offset(marker: DataFrame, source: str, tier: str) -> int:
    """Offset of a progress marker; 0 unless source and tier fit."""
    rows = marker.filter((F.col("source") == source) & (F.col("tier") == tier))
    return rows.agg(F.max("offset_done")).first()[0] or 0


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Write a stream to Parquet below ``<path>/batch=<n>`` until its input is used up."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(run)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rate_window(
    log: DataFrame,
    window: Column,
    by: tuple[str, ...] = (),
    ts: str = "ts",
    delay: str | None = "10 minutes",
) -> DataFrame:
    """ok, failed and bytes per time window; late rows within ``delay`` still count.

    ``log``: (ts, ok, bytes). Works on a stream and on a table.
    """
    rows = log.withWatermark(ts, delay) if delay else log
    return rows.groupBy(window.alias("window"), *by).agg(
        F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.sum("bytes").alias("bytes"),
    )


def rates_to_table(
    log: DataFrame, window: Column, path: str, checkpoint: str, by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Sums of each batch per time window below ``<path>/batch=<n>``, for ``merged_rates``.

    No row is ever too late: nothing is kept in state and no watermark is needed.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rates = rate_window(batch, window, by, delay=None)
        rates.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        log.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged_rates(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals per window of all batches ``rates_to_table`` has written, in whatever order they came."""
    sums = [F.sum(c).alias(c) for c in ("ok", "failed", "bytes")]
    return spark.read.parquet(path).groupBy("window", *by).agg(*sums)


def latest_state(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Final rows of a stream written in update mode: the last batch per key wins."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in [*keys, "batch"]]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return last.select(*keys, "r.*")


def dedupe_stream(stream: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day"):
    """Each key once, however often it is delivered within ``delay``; ``dedupe_to_table`` has no such limit."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


@dataclass(frozen=True)
class Seal:
    """How a rotating sink writes its closed chunks: constants of the run and of the names."""

    baked_at: str
    baker_version: str = "1"
    prefix: str = S.ASSET_PREFIX


def rotating_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    group: list[str] = GROUP,
    seal: Seal | None = None,
) -> StreamingQuery:
    """Append rows (group, id, length, …) to numbered chunks, rotated as they fill up.

    A chunk is closed after the row that fills it. The open chunk of each group and its bytes are kept
    next to the data, one state table per batch, so a repeated batch starts from the same state. A
    material that is met again while its chunk is open goes to that chunk; once it is closed, to the
    chunk that is open then, as a further row of which the last one counts.

    Rows lie below ``<path>/rows/batch=<n>`` in files that hold a range of the chunks of one group each,
    so there are as many files as tasks and groups call for, however small the chunks; a chunk that is
    larger than a task's share spans several. The state lies below ``<path>/state/batch=<n>``, the files
    of all open chunks below ``<path>/open/batch=<n>``. With ``seal`` the rows are textures (channel,
    payload), and a batch that closes chunks writes their bundles below ``<path>/bundles/batch=<n>`` and
    the ranges in them below ``<path>/rowmap/batch=<n>``; it reads the files of those chunks and no
    others. ``seal_open`` does so for the chunks still open.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        before = f"{path}/state/batch={batch_id - 1}"
        if batch_id and not exists(before):
            raise RuntimeError(f"{before} is missing: chunk numbers would start again")
        if batch_id:
            carry = spark.read.parquet(before)
            still = spark.read.parquet(f"{path}/open/batch={batch_id - 1}")
        else:
            own = StructType([batch.schema[g] for g in group]).add("chunk", "integer")
            carry = spark.createDataFrame([], own.add("open_bytes", "long"))
            still = spark.createDataFrame([], StructType(own.fields[:-1]).add("file", "string"))
        sizes = batch.groupBy(*group, "id").agg(F.sum("length").alias("length"))
        met = _open_materials(spark, path, still, batch, group)
        known = sizes.join(met, [*group, "id"])
        more = known.groupBy(*group).agg(F.sum("length").alias("_more"))
        begin = carry.join(more, group, "left").select(
            *group, "chunk", (F.col("open_bytes") + F.coalesce("_more", F.lit(0))).alias("open_bytes")
        )
        fresh = sizes.join(met, [*group, "id"], "left_anti")
        chunks = chunk_by_bytes(fresh, group, max_bytes, carry=begin if batch_id else None)
        places = chunks.select(*group, "id", "chunk").unionByName(known.select(*group, "id", "chunk"))
        rows = f"{path}/rows/batch={batch_id}"
        by_chunk = [*group, "chunk"]
        placed = batch.join(places, [*group, "id"]).repartitionByRange(*by_chunk, "id")
        placed.sortWithinPartitions(*by_chunk).write.mode("overwrite").partitionBy(*group).parquet(rows)
        batch.unpersist()
        written = spark.read.schema(_row_schema(batch, group)).parquet(rows)
        used = written.groupBy(*group, "chunk", F.col("_metadata.file_path").alias("file")).agg(
            F.sum("length").alias("length")
        )
        used = keep(used, "chunk-files")
        files = still.unionByName(used.select(*group, "chunk", "file"))
        per_chunk = used.select(*group, "chunk", "length").unionByName(
            carry.select(*group, "chunk", F.col("open_bytes").alias("length"))
        ).groupBy(*group, "chunk").agg(F.sum("length").alias("length"))
        top = per_chunk.groupBy(*group).agg(
            F.max("chunk").alias("c"), F.max_by("length", "chunk").alias("b")
        )
        full = F.col("b") >= max_bytes
        state = top.select(
            *group,
            F.when(full, F.col("c") + 1).otherwise(F.col("c")).alias("chunk"),
            F.when(full, F.lit(0)).otherwise(F.col("b")).cast("long").alias("open_bytes"),
        )
        state.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        now = spark.read.parquet(f"{path}/state/batch={batch_id}").select(*group, F.col("chunk").alias("_open"))
        files = files.join(now, group).select(*files.columns, (F.col("chunk") < F.col("_open")).alias("_closed"))
        files.filter("NOT _closed").drop("_closed").write.mode("overwrite").parquet(f"{path}/open/batch={batch_id}")
        if seal is not None:
            _seal(spark, path, files.filter("_closed").drop("_closed"), batch, batch_id, seal)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _row_schema(batch: DataFrame, group: list[str]) -> StructType:
    """Schema of written rows; the columns in the folder names keep their types."""
    rest = [f for f in batch.schema.fields if f.name not in group]
    return StructType([*rest, *[batch.schema[g] for g in group]]).add("chunk", "integer")


def chunk_rows(spark: SparkSession, path: str, files: DataFrame, schema: StructType) -> DataFrame:
    """Rows of the chunks whose ``files`` (file) are given: these files and no others are read.

    A file may hold rows of further chunks of its group; joining by (group, chunk) leaves them out.
    """
    paths = [unquote(r["file"]) for r in files.select("file").distinct().collect()]  # one per group, batch and task
    reader = spark.read.schema(schema)
    return reader.option("basePath", f"{path}/rows").parquet(*paths) if paths else spark.createDataFrame([], schema)


def _open_materials(
    spark: SparkSession, path: str, still: DataFrame, batch: DataFrame, group: list[str]
) -> DataFrame:
    """(group, id, chunk) of the materials in open chunks of the groups that ``batch`` has rows of."""
    files = still.join(batch.select(*group).distinct(), group)
    rows = chunk_rows(spark, path, files, _row_schema(batch, group)).select(*group, "id", "chunk")
    return rows.join(files.select(*group, "chunk").distinct(), [*group, "chunk"], "left_semi").distinct()


ROWMAP_ROWS = (
    "parquet_file string, row_idx int, id string, channel string, offset bigint, length bigint, "
    "source string, tier string, category string"
)


def _seal(
    spark: SparkSession, path: str, files: DataFrame, batch: DataFrame, batch_id: int, seal: Seal
) -> None:
    """Write the bundles and the rowmap of the chunks whose ``files`` (group, chunk, file) are given."""
    closed = files.select(*GROUP, "chunk").distinct()
    rowmap = f"{path}/rowmap/batch={batch_id}"
    if closed.isEmpty():
        spark.createDataFrame([], ROWMAP_ROWS).write.mode("overwrite").parquet(rowmap)
        return
    named = bundle_files(closed.withColumn("numbered", F.lit(True)), seal.prefix, first_unnumbered=True)
    bundles = keep(numbered(named).select(*GROUP, "chunk", "parquet_file", "bundle_no"), "bundles")
    rows = chunk_rows(spark, path, files, _row_schema(batch, GROUP))
    placed = rows.join(bundles, [*GROUP, "chunk"])
    n_tasks = write_tasks(spark, bundles.count(), rows.agg(F.sum("length")).first()[0])
    null = F.lit(None).cast("string")
    write_rows(
        placed.withColumns({"source_url": null, "source_license": null, "planned": F.lit(True)}),
        n_tasks, f"{path}/bundles/batch={batch_id}", seal.baker_version, seal.baked_at, "overwrite",
    )
    located = rowmap_of_placed(spark, f"{path}/bundles/batch={batch_id}", placed.drop("payload"), bundles)
    located.select(*[f.split()[0] for f in ROWMAP_ROWS.split(", ")]).write.mode("overwrite").parquet(rowmap)


def seal_open(spark: SparkSession, path: str, seal: Seal) -> None:
    """Write bundles and rowmap of the chunks that are still open when a stream has ended.

    They take the place of the next batch: should the stream go on, that batch replaces them.
    """
    last = spark.read.parquet(f"{path}/state").agg(F.max("batch")).first()[0]
    files = spark.read.parquet(f"{path}/open/batch={last}")
    _seal(spark, path, files, spark.read.parquet(f"{path}/rows/batch={last}").drop("chunk"), last + 1, seal)


def sealed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rowmap, files) of all bundles a rotating sink has written, for ``fetch_ranges``."""
    rowmap = spark.read.parquet(f"{path}/rowmap")
    found = F.regexp_extract("path", r"/batch=(\d+)/bundle=([^/]+)/", 1).cast("int")
    name = F.regexp_extract("path", r"/batch=(\d+)/bundle=([^/]+)/", 2)
    files = list_files(spark, f"{path}/bundles", "*.parquet").select(
        found.alias("batch"), F.concat(name, F.lit(".parquet")).alias("parquet_file"), "path"
    )
    used = rowmap.select("batch", "parquet_file").distinct()
    return rowmap.drop("batch"), files.join(used, ["batch", "parquet_file"]).drop("batch")
