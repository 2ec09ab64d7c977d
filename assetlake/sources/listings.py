"""Upstream listings landed as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import normalize as N
from assetlake.sources.bundles import file_contents, list_files

Paths = str | list[str]


def explode_pages(pages: DataFrame, items: str) -> DataFrame:
    """One row per item of a paged listing; an empty page adds nothing."""
    return pages.select(F.explode(items).alias("item")).select("item.*")


def read_listing_pages(
    spark: SparkSession, path: Paths, items: str = "foundAssets", schema: str | None = None
) -> DataFrame:
    """All items of all pages; pages are separate files, so they are read in parallel."""
    if schema is None:
        schema = {"foundAssets": S.PAGED_ASSETS_SCHEMA, "results": S.PAGED_PACKAGES_SCHEMA}[items]
    return explode_pages(spark.read.json(path, schema=schema, multiLine=True), items)


def last_pages(pages: DataFrame, items: str, page_size: int = S.LISTING_PAGE_SIZE) -> DataFrame:
    """Pages that end a listing: empty or shorter than the page size."""
    n = F.coalesce(F.size(items), F.lit(0))
    return pages.withColumn("n_items", n).withColumn("is_last", n < page_size)


def explode_slugs(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row per key of a JSON object (slug, name, tags, categories)."""
    parsed = F.from_json(column, f"map<string, {S.SLUG_ENTRY_TYPE}>")
    return docs.select(F.explode(parsed).alias("slug", "entry")).select("slug", "entry.*")


def read_listing_map(spark: SparkSession, path: Paths) -> DataFrame:
    return explode_slugs(spark.read.text(path, wholetext=True))


def read_scalar_materials(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.json(path, schema=S.SCALAR_MATERIAL_SCHEMA, multiLine=True)


def explode_file_tree(docs: DataFrame, key: str, column: str = "value") -> DataFrame:
    """Map name -> tier -> format tree of an asset as (key, map_no, map_name, tier, formats).

    Entries that are no map (renderer files beside the maps) come out without formats and drop.
    """
    tree = F.from_json(column, "map<string, string>")
    maps = docs.select(key, F.posexplode(tree).alias("map_no", "map_name", "tiers"))
    tiers = F.from_json("tiers", S.FILE_TREE_TYPE)
    return maps.select(key, "map_no", "map_name", F.explode(tiers).alias("tier", "formats"))


def read_asset_files(spark: SparkSession, path: Paths) -> DataFrame:
    """File trees of assets, one JSON file per asset named ``<slug>.json``."""
    docs = file_contents(list_files(spark, path, nested=False))
    slug = F.regexp_extract("path", r"(?s)([^/]*)\.json$", 1)
    return explode_file_tree(docs.select(slug.alias("slug"), F.col("payload").cast("string").alias("value")), "slug")


def map_urls(tree: DataFrame, key: str, tier: str, source: str = "polyhaven") -> DataFrame:
    """(key, channel, url): the first map of each channel that has a URL for the tier."""
    url = N.pick_format("formats")
    rows = (
        tree.filter(F.col("tier") == S.FILE_TIER.get(tier, ""))
        .select(key, "map_no", N.normalize_channel(source, "map_name").alias("channel"),
                url.alias("url"))
        .filter(F.col("channel").isNotNull() & F.col("url").isNotNull())
    )
    return rows.groupBy(key, "channel").agg(F.min_by("url", "map_no").alias("url"))


def _record(df: DataFrame, **cols) -> DataFrame:
    """Material records with the defaults of optional fields filled in."""
    defaults = {
        "tags": F.array().cast("array<string>"),
        "source_license": F.lit("CC0-1.0"),
        "last_updated": F.lit(""),
        "available_tiers": F.array().cast("array<string>"),
        "maps": F.array().cast("array<string>"),
        "status": F.lit("ok"),
        "needs_mtlx_bake": F.lit(False),
    }
    cols = {**defaults, **cols}
    fields = [f for f in S.INDEX_SCHEMA.fields if f.name in cols]
    out = [cols[f.name].cast(f.dataType).alias(f.name) for f in fields]
    missing = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in S.INDEX_SCHEMA.fields
        if f.name not in cols
    ]
    return df.select(*out, *missing, cols["needs_mtlx_bake"].alias("needs_mtlx_bake")).select(
        *[f.name for f in S.INDEX_SCHEMA.fields], "needs_mtlx_bake"
    )


def paged_asset_records(assets: DataFrame, tier: str) -> DataFrame:
    """Records of paged assets that can be downloaded at ``tier``; URL kept as ``url``."""
    downloads = F.col("downloadFolders.default.downloadFiletypeCategories.zip.downloads")
    source = F.lit("ambientcg")
    rows = assets.withColumn("url", N.download_url(downloads, tier)).filter("url is not null")
    return _record(
        rows,
        id=F.col("assetId"),
        source=source,
        name=F.coalesce("displayName", "assetId"),
        category=N.normalize_category(F.coalesce("displayCategory", "category", F.lit(""))),
        tags=F.coalesce("tags", F.array().cast("array<string>")),
        source_url=N.upstream_url(source, "assetId"),
        last_updated=N.date_part10("releaseDate"),
        available_tiers=F.array(F.lit(tier)),
    )


def package_records(packages: DataFrame) -> DataFrame:
    """Records of paged packages; a package without a file is failed."""
    source = F.lit("gpuopen")
    there = F.coalesce(F.col("file_url"), F.lit("")) != ""
    return _record(
        packages,
        id=F.col("id"),
        source=source,
        name=F.coalesce("label", "id"),
        category=F.when(there, N.normalize_category(F.coalesce("category", F.lit(""))))
        .otherwise("other"),
        tags=N.tags_of_json("tags"),
        source_url=F.when(there, N.upstream_url(source, "id")).otherwise(""),
        source_license=F.when(there, F.lit("TBV")).otherwise("CC0-1.0"),
        last_updated=F.coalesce("updated_date", F.lit("")),
        status=F.when(there, F.lit("ok")).otherwise("failed"),
    )


def slug_records(assets: DataFrame, tier: str) -> DataFrame:
    source = F.lit("polyhaven")
    return _record(
        assets,
        id=F.col("slug"),
        source=source,
        name=F.coalesce("name", "slug"),
        category=N.normalize_category(N.first_category("categories")),
        tags=F.coalesce("tags", F.array().cast("array<string>")),
        source_url=N.upstream_url(source, "slug"),
        available_tiers=F.array(F.lit(tier)),
    )


def scalar_records(materials: DataFrame, clamp: bool = False) -> DataFrame:
    source = F.lit("physicallybased")
    return _record(
        materials,
        id=N.slug("name"),
        source=source,
        name=F.col("name"),
        category=N.normalize_category(N.first_category("category")),
        source_url=N.upstream_url(source, F.lit("")),
        color_hex=N.rgb_to_hex("color", clamp),
        roughness=F.col("roughness"),
        metalness=F.col("metalness"),
        ior=F.col("ior"),
    )
