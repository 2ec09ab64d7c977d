"""Projections, filters and predicates over index and texture tables."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import _c, download_url, tier_px
from assetlake.functions.payload import png_ok, sha256, size
from assetlake.sinks.bundles import only_ok

__all__ = ["only_ok"]


def not_failed(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce("status", F.lit("ok")) != "failed")


def by_category(df: DataFrame, category: str | None, known: list[str] | None = None) -> DataFrame:
    """Rows of one category. A category missing from a non-empty ``known`` gives no row."""
    if not category:
        return df
    if known and category not in known:
        warnings.warn(f"category {category!r} is not one of {sorted(known)}", stacklevel=2)
        return df.filter(F.lit(False))
    return df.filter(F.col("category") == category)


def in_range(col: Column | str, lo: float, hi: float) -> Column:
    """Inclusive at both ends; null never matches."""
    return F.coalesce(_c(col).between(lo, hi), F.lit(False))


def widen(x: float, half_width: float = S.SCALAR_WIDEN) -> tuple[float, float]:
    """Range around a scalar, kept inside 0..1."""
    return max(0.0, x - half_width), min(1.0, x + half_width)


def scalar_range(
    name: str, value: float | None, bounds: tuple[float, float] | None
) -> tuple[float, float] | None:
    """Bounds of a scalar shorthand or of an explicit range; giving both is an error."""
    if value is not None and bounds is not None:
        raise ValueError(f"pass {name} or {name}_range, not both")
    return bounds if value is None else widen(value)


def has_tier(df: DataFrame, tier: str | None) -> DataFrame:
    return df if tier is None else df.filter(F.array_contains("available_tiers", tier))


def from_sources(
    df: DataFrame,
    sources: list[str] | None = None,
    manifest_files: DataFrame | None = None,
    tier: str | None = None,
) -> DataFrame:
    """Rows of the given sources, or of those the manifest has for the tier."""
    if sources is not None:
        return df.filter(F.col("source").isin(sources))
    if manifest_files is None:
        return df
    have = manifest_files if tier is None else manifest_files.filter(F.col("tier") == tier)
    return df.join(have.select("source").distinct(), "source", "left_semi")


def has_download(df: DataFrame, tier: str, downloads: str = "downloads") -> DataFrame:
    return df.filter(download_url(downloads, tier).isNotNull())


def listing_window(df: DataFrame, order: list[str], offset: int = 0, limit: int | None = None):
    """Slice of an ordered listing; ``limit`` 0 or None means the rest."""
    out = df.orderBy(*order).offset(offset)
    return out.limit(limit) if limit else out


def first_ids(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` ids in order; 0 or None means all."""
    ids = df.select("id").distinct().orderBy("id")
    return ids.limit(limit) if limit else ids


def index_projection(records: DataFrame, source: str | None = None) -> DataFrame:
    """Index entries: status is kept only for failed rows, empty hash maps are dropped."""
    out = []
    for f in S.INDEX_SCHEMA.fields:
        if f.name == "status" and "status" in records.columns:
            col = F.when(F.col("status") == "failed", F.col("status"))
        elif f.name == "source" and source is not None:
            col = F.lit(source)
        elif f.name == "texture_hashes" and f.name in records.columns:
            col = F.when(F.size(f.name) > 0, F.col(f.name))
        elif f.name in records.columns:
            col = F.col(f.name)
        else:
            col = F.lit(None)
        out.append(col.cast(f.dataType).alias(f.name))
    return records.select(*out)


def is_scalar_only(maps: Column | str = "maps") -> Column:
    return F.size(F.coalesce(_c(maps), F.array().cast("array<string>"))) == 0


def needs_bake(has_document: Column | str, n_textures: Column | str) -> Column:
    """A shader document is there, but no texture."""
    return _c(has_document) & (_c(n_textures) == 0)


def with_hashes(textures: DataFrame) -> DataFrame:
    """Long rows with sha256 and byte length of the payload; the payload column goes."""
    hashed = textures.withColumns({"sha256": sha256("payload"), "length": size("payload")})
    return hashed.drop("payload")


def texture_hashes(
    hashed: DataFrame, keys: list[str], channels: list[str] | None = None
) -> DataFrame:
    """(keys, maps, texture_hashes) from hashed long rows, channels sorted.

    One aggregate per channel, so nothing is gathered and repeated rows are combined early.
    """
    names = sorted(channels or S.CHANNELS)
    entry = F.struct("sha256", F.col("length").alias("size"))
    per_channel = [
        F.max(F.when(F.col("channel") == c, entry)).alias(f"_{i}") for i, c in enumerate(names)
    ]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("key"), F.col(f"_{i}").alias("value"))
          for i, c in enumerate(names)]
    )
    present = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return hashed.groupBy(*keys).agg(*per_channel).select(*keys, present.alias("texture_hashes")).select(
        *keys, F.map_keys("texture_hashes").alias("maps"), "texture_hashes"
    )


def hashed_textures(textures: DataFrame, valid: Column | None = None) -> DataFrame:
    """Long rows with ``sha256``, ``length`` and ``valid``: all later steps do without the payload."""
    ok = png_ok("payload") if valid is None else valid
    return textures.withColumns(
        {"sha256": sha256("payload"), "length": size("payload"), "valid": F.coalesce(ok, F.lit(False))}
    )


def drop_invalid_channels(
    records: DataFrame, hashed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(records, textures) without invalid textures; works on ``hashed_textures`` rows.

    A record left without a texture, or one that needs baking, is failed; ``maps`` and
    ``texture_hashes`` are those of the textures that stay.
    """
    good = hashed.filter(F.col("valid") & ~F.startswith("channel", F.lit("_"))).drop("valid")
    per_id = texture_hashes(good, ["source", "id"])
    rest = records.drop("maps", "texture_hashes")
    bake = F.col("needs_mtlx_bake") if "needs_mtlx_bake" in records.columns else F.lit(False)
    joined = rest.join(per_id, ["source", "id"], "left")
    empty = F.array().cast("array<string>")
    failed = (F.col("status") == "failed") | bake | F.col("maps").isNull()
    out = joined.withColumns(
        {
            "status": F.when(failed, F.lit("failed")).otherwise(F.col("status")),
            "maps": F.coalesce("maps", empty),
        }
    )
    return out, good


def derivable(pairs: DataFrame, src: str = "src_tier", dst: str = "dst_tier") -> DataFrame:
    """Tier pairs whose target is strictly smaller."""
    return pairs.filter(tier_px(dst) < tier_px(src))
