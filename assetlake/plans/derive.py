"""Smaller or re-encoded tiers made from the payloads of an existing one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from assetlake import schemas as S
from assetlake.functions import png
from assetlake.functions.payload import has_magic
from assetlake.operators.lookup import enrich
from assetlake.operators.rowmap import build_rowmap, collector
from assetlake.operators.select import index_projection
from assetlake.sinks.bundles import with_bundle, write_partitioned_bundle
from assetlake.sources.bundles import footers, list_files, record_batches

Resampler = Callable[[bytes, int], bytes]
Encoder = Callable[[bytes, str], bytes]


def map_payloads(
    textures: DataFrame, change: Callable[[bytes, str], bytes], keep_failed: bool = False
) -> DataFrame:
    """Apply ``change(payload, mode)`` to every payload; a failure nulls this payload only.

    ``mode`` is that of the channel: normal, srgb or linear. Failed rows drop unless
    ``keep_failed``, then they stay with their ``error``.
    """
    kept = [f for f in textures.schema.fields if f.name not in ("payload", "length")]
    schema = StructType(list(kept)).add("length", "long").add("error", "string").add("payload", "binary")
    arrow = to_arrow_schema(schema)
    names = [f.name for f in kept]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                row = [columns[n][i].as_py() for n in names]
                mode = channel_mode(columns["channel"][i].as_py())
                try:
                    data, error = change(columns["payload"][i].as_py(), mode), None
                except Exception as exc:
                    data, error = None, f"{type(exc).__name__}: {exc}"
                yield (*row, None if data is None else len(data), error, data)

    out = textures.mapInArrow(lambda batches: record_batches(rows(batches), arrow), schema)
    return out if keep_failed else out.filter("payload is not null").drop("error")


def channel_mode(channel: str) -> str:
    if channel == "normal":
        return "normal"
    return "srgb" if channel in ("color", "emission") else "linear"


def resized(textures: DataFrame, px: int, resampler: Resampler = png.shrink) -> DataFrame:
    """Payloads shrunk to fit ``px``; smaller ones are unchanged."""
    return map_payloads(textures, lambda data, _: resampler(data, px))


def derive_tier(
    textures: DataFrame, source_tier: str, target_tier: str, resampler: Resampler = png.shrink
) -> DataFrame:
    """Long rows of ``target_tier`` made from those of ``source_tier``; the target is smaller."""
    if S.TIER_PX[target_tier] >= S.TIER_PX[source_tier]:
        raise ValueError(f"{target_tier} is not smaller than {source_tier}")
    rows = textures.filter(F.col("tier") == source_tier)
    out = resized(rows, S.TIER_PX[target_tier], resampler)
    return out.withColumn("tier", F.lit(target_tier))


def transcode_tier(
    textures: DataFrame, source_tier: str, encoder: Encoder, prefix: str = "ktx2-"
) -> DataFrame:
    """Long rows re-encoded at the same resolution; output without the KTX2 magic is a failure."""
    rows = textures.filter(F.col("tier") == source_tier)
    out = map_payloads(rows, encoder).filter(has_magic("payload", S.KTX2_MAGIC))
    return out.withColumn("tier", F.lit(f"{prefix}{source_tier}"))


def thumbnails(
    textures: DataFrame, existing: DataFrame | None = None, px: int = 128,
    resampler: Resampler = png.shrink,
) -> DataFrame:
    """(source, id, channel, file, content) of thumbnails that are not there yet."""
    rows = textures
    if existing is not None:
        have = existing.select("source", "id", "channel").distinct()
        rows = rows.join(have, ["source", "id", "channel"], "left_anti")
    thumbs = resized(rows, px, resampler)
    file = F.concat_ws("/", "source", "id", F.concat("channel", F.lit("_thumb.png")))
    return thumbs.select("source", "id", "channel", file.alias("file"), F.col("payload").alias("content"))


def publish_tier(
    derived: DataFrame,
    index: DataFrame,
    path: str,
    baker_version: str,
    baked_at: str,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    prefix: str = S.ASSET_PREFIX,
) -> tuple[DataFrame, DataFrame]:
    """Write derived rows as bundles; returns (rowmap, index entries of the new tier).

    Materials without any payload left are not in the result. ``derived`` is read twice, once for
    its lengths, so hand over a written table. Rows without a category get that of the index,
    which shuffles them.
    """
    spark = derived.sparkSession
    rows = derived if "category" in derived.columns else enrich(derived, index)
    chunks, bundles = write_partitioned_bundle(
        rows, index, path, baker_version, baked_at, max_bytes, prefix=prefix
    )
    rowmap = rowmap_of(spark, path, rows.drop("payload"), chunks, bundles)
    meta = rows.groupBy("source", "id", "tier").agg(
        F.array_sort(F.collect_set("channel")).alias("maps")
    )
    entries = enrich(meta, index).join(
        index.select("source", "id", "tags", "last_updated"), ["source", "id"], "left"
    )
    new_index = index_projection(entries.withColumn("available_tiers", F.array("tier")))
    return rowmap, new_index


def rowmap_of(spark, path: str, textures: DataFrame, chunks: DataFrame, bundles: DataFrame):
    """Long rowmap of the bundles below ``path``; their physical parts go by the bundle name."""
    return rowmap_of_placed(spark, path, with_bundle(textures, chunks, bundles), bundles)


def rowmap_of_placed(spark, path: str, placed: DataFrame, bundles: DataFrame) -> DataFrame:
    """The same for textures that carry their ``parquet_file`` already."""
    parts = footers(list_files(spark, path, "*.parquet"))
    named = parts.withColumn(
        "parquet_file",
        F.concat(F.regexp_extract("path", r"/bundle=([^/]+)/", 1), F.lit(".parquet")),
    )
    located = build_rowmap(named, collector(placed))
    cells = bundles.select("parquet_file", "source", "tier", "category")
    return located.join(cells, "parquet_file")
