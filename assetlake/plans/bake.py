"""From landed listings and archives to bundles, rowmaps, index and manifest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import normalize as N
from assetlake.functions.names import rowmap_name
from assetlake.operators import releases as R
from assetlake.operators import rowmap as M
from assetlake.operators import select as P
from assetlake.operators.quality import require_success, safe_members
from assetlake.plans.derive import Resampler, resized, rowmap_of
from assetlake.session import cut, run_dir
from assetlake.sinks.bundles import only_ok, write_partitioned_bundle
from assetlake.sinks.documents import write_index, write_rowmaps
from assetlake.sinks.files import write_files
from assetlake.sources.bundles import archive_members, list_files, read_members


def member_channel(source: str, member: Column | str) -> Column:
    """Canonical channel of an archive member by the naming habit of its source."""
    if source == "gpuopen":
        return N.channel_from_tokens(member, source)
    return N.normalize_channel(source, N.channel_from_member(member))


def archive_textures(
    spark: SparkSession, path: str, source: str, records: DataFrame | None = None
) -> DataFrame:
    """(source, id, [category,] channel, member, payload) of the safe archives ``<id>.zip``.

    Directories of the archives are read first; only members that become a texture are inflated.
    With ``records`` only their materials are read, and the category comes along.
    """
    members = archive_members(list_files(spark, path, "*.zip"))
    chosen = chosen_members(safe_members(members, check_paths=False), source)
    extra = []
    if records is not None:
        cells = records.filter(F.col("source") == source).select("id", "category")
        chosen, extra = chosen.join(cells, "id"), ["category"]
    cols = ["archive", "member_no", "member", "id", "channel", *extra]
    return read_members(chosen.select(*cols)).select(
        F.lit(source).alias("source"), "id", *extra, "channel", "member", "payload"
    )


def chosen_members(members: DataFrame, source: str) -> DataFrame:
    """One member per (archive, channel), the first in archive order."""
    named = (
        members.filter(~F.endswith("member", F.lit("/")))
        .withColumn("channel", member_channel(source, "member"))
        .filter("channel is not null")
        .withColumn("id", F.regexp_extract("archive", r"([^/]+)\.zip$", 1))
        .select("archive", "id", "channel", "member_no", "member")
    )
    return M.first_channel_wins(named, ["archive", "id"])


@dataclass
class Release:
    """Tables of a baked release."""

    index: DataFrame
    rowmap: DataFrame
    bundles: DataFrame
    files: DataFrame


def bake(
    records: DataFrame,
    textures: DataFrame,
    tier: str,
    path: str,
    release_tag: str,
    base_url: str,
    baked_at: str,
    baker_version: str = "1",
    category: str | None = None,
    max_bytes: int = S.MAX_BUNDLE_BYTES,
    rotate: str = "bytes",
    min_success: float = 0.0,
    prefix: str = S.ASSET_PREFIX,
    resampler: Resampler | None = None,
) -> Release:
    """Validate, hash, pack and publish the textures of one tier below ``path``.

    ``textures``: (source, id, category, channel, payload). Payloads are read, resampled, hashed
    and written to a scratch table in one pass and packed in a second one; everything between and
    after plans on lengths and hashes. Without a category the textures are joined with the records
    first, which shuffles them.
    """
    spark = records.sparkSession
    records = P.by_category(records, category)
    keys = ["source", "id", "category", "channel"]
    if "category" not in textures.columns:
        textures = textures.join(records.select("source", "id", "category"), ["source", "id"])
    fitted = P.by_category(textures, category).select(*keys, "payload")
    if resampler is not None:
        fitted = resized(fitted, S.TIER_PX[tier], resampler).drop("length")
    scratch = run_dir(spark, "bake")
    fitted.transform(P.hashed_textures).withColumn("tier", F.lit(tier)).write.parquet(scratch)
    stored = spark.read.parquet(scratch)

    checked, good = P.drop_invalid_channels(records, stored.drop("payload"))
    checked = cut(checked)
    require_success(checked, min_success)
    ok = only_ok(checked)
    planned = good.join(ok.select("source", "id"), ["source", "id"], "left_semi")
    bundle_path = f"{path}/bundles"
    chunks, bundles = write_partitioned_bundle(
        stored.filter("valid"), ok, bundle_path, baker_version, baked_at, max_bytes, rotate,
        prefix, planned=planned,
    )
    located = rowmap_of(spark, bundle_path, planned, chunks, bundles)
    rowmap_path = f"{path}/rowmap"
    located.withColumn("release_tag", F.lit(release_tag)).write.parquet(rowmap_path)
    rowmap = spark.read.parquet(rowmap_path)

    has_tier = F.when(
        F.coalesce("status", F.lit("ok")) == "ok", F.array_union("available_tiers", F.array(F.lit(tier)))
    ).otherwise(F.col("available_tiers"))
    index = P.index_projection(checked.withColumn("available_tiers", has_tier))
    write_index(index, f"{path}/index")

    write_rowmaps(rowmap, bundles, release_tag, f"{path}/rowmaps", prefix)
    names = bundles.select(F.col("parquet_file").alias("file_name")).union(
        bundles.select(rowmap_name("parquet_file", prefix))
    )
    files = R.parsed_assets(names, prefix)
    manifest = R.manifest_document(R.manifest_rollup(names, prefix), release_tag, base_url)
    write_files(manifest, path)
    return Release(index, rowmap, bundles, files)


def prefetch(
    rowmap: DataFrame, source: str, tier: str, material: str | None = None
) -> DataFrame:
    """Requests (source, tier, id, channel) for every channel of all materials, or of one."""
    rows = rowmap.filter((F.col("source") == source) & (F.col("tier") == tier))
    if material is not None:
        rows = rows.filter(F.col("id") == material)
    return rows.select("source", "tier", "id", "channel").distinct()
