"""Joins that resolve names, metadata and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.normalize import category_segment, channel_alias


def enrich(df: DataFrame, index: DataFrame) -> DataFrame:
    """Metadata by (source, id); a missing entry gives category other, CC0, no URL and id as name."""
    meta = index.select(
        "source", "id",
        F.col("name").alias("_name"), F.col("category").alias("_category"),
        F.col("source_url").alias("_url"), F.col("source_license").alias("_license"),
    )
    return df.join(meta, ["source", "id"], "left").select(
        *df.columns,
        F.coalesce("_name", "id").alias("name"),
        F.coalesce("_category", F.lit("other")).alias("category"),
        F.coalesce("_url", F.lit("")).alias("source_url"),
        F.coalesce("_license", F.lit("CC0-1.0")).alias("source_license"),
    )


def lookup_texture(
    requests: DataFrame, manifest_files: DataFrame, rowmap: DataFrame
) -> DataFrame:
    """Resolve (source, tier, id, channel) level by level: tier, source, material, channel.

    ``error_kind`` names the first level that is missing and ``available`` lists its sorted
    alternatives. Ids of a source can be any number, so a missing material gets no list; its
    alternatives come as rows, by ``alternatives``.
    """
    levels = manifest_files.select("tier", "source").distinct()
    all_tiers = levels.agg(F.array_sort(F.collect_set("tier"))).scalar()
    per_tier = levels.groupBy("tier").agg(F.array_sort(F.collect_set("source")).alias("sources"))

    key = ["source", "tier", "id"]
    wanted = requests.select(*key).distinct()
    place = F.struct("offset", "length", "parquet_file")
    ranges = (
        rowmap.join(wanted, key, "left_semi")
        .groupBy(*key, "channel")
        .agg(F.max_by(place, "parquet_file").alias("range"))
    )
    by_channel = F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "range"))))
    entries = ranges.groupBy(*key).agg(by_channel.alias("ranges"))
    hit = F.try_element_at("ranges", F.col("channel"))
    error = (
        F.when(F.col("sources").isNull(), "tier")
        .when(~F.array_contains("sources", F.col("source")), "source")
        .when(F.col("ranges").isNull(), "material")
        .when(hit.isNull(), "channel")
    )
    joined = (
        requests.join(per_tier, "tier", "left")
        .join(entries, key, "left")
        .withColumn("error_kind", error)
        .withColumn("hit", hit)
    )
    available = (
        F.when(F.col("error_kind") == "tier", all_tiers)
        .when(F.col("error_kind") == "source", F.col("sources"))
        .when(F.col("error_kind") == "channel", F.array_sort(F.map_keys("ranges")))
    )
    found = F.col("error_kind").isNull()
    return joined.select(
        *requests.columns,
        *[F.when(found, F.col(f"hit.{c}")).alias(c) for c in ("parquet_file", "offset", "length")],
        "error_kind",
        available.alias("available"),
    )


def alternatives(resolved: DataFrame, rowmap: DataFrame) -> DataFrame:
    """(source, tier, id): the materials there are instead of those ``lookup_texture`` missed.

    One set per source and tier with a miss, however many requests missed there; join it to the
    requests by source and tier.
    """
    missed = resolved.filter("error_kind = 'material'").select("source", "tier").distinct()
    return materials(rowmap.join(missed, ["source", "tier"], "left_semi"))


def tiers(manifest_files: DataFrame) -> DataFrame:
    return manifest_files.select("tier").distinct().orderBy("tier")


def sources(manifest_files: DataFrame, tier: str) -> DataFrame:
    return (
        manifest_files.filter(F.col("tier") == tier).select("source").distinct().orderBy("source")
    )


def materials(rowmap: DataFrame) -> DataFrame:
    """(source, tier, id) of every material that has a texture."""
    return rowmap.select("source", "tier", "id").distinct()


def channels(rowmap: DataFrame) -> DataFrame:
    """(source, tier, id, channels) with the channels sorted."""
    return rowmap.groupBy("source", "tier", "id").agg(
        F.array_sort(F.collect_set("channel")).alias("channels")
    )


def fill_scalars(df: DataFrame, index: DataFrame, maps: str = "maps") -> DataFrame:
    """Scalars of a material, each only where the texture of that channel is absent."""
    names = {"roughness": "roughness", "metalness": "metalness", "color_hex": "color", "ior": None}
    scal = index.select("source", "id", *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.join(scal, ["source", "id"], "left")
    out: list[Column] = []
    for name, channel in names.items():
        value = F.col(f"_{name}")
        if channel:
            value = F.when(~F.array_contains(maps, channel), value)
        out.append(value.alias(name))
    return joined.select(*df.columns, *out)


def with_thumbnail(df: DataFrame, inventory: DataFrame, channel: str = "color") -> DataFrame:
    """Adds ``has_<channel>``: whether a thumbnail file is in the inventory."""
    have = inventory.filter(F.col("channel") == channel).select("source", "id").distinct()
    flagged = have.withColumn("_have", F.lit(True))
    return df.join(flagged, ["source", "id"], "left").select(
        *df.columns, F.col("_have").isNotNull().alias(f"has_{channel}")
    )


def map_channel(df: DataFrame, channel_map: DataFrame, raw: str = "raw") -> DataFrame:
    """Canonical channel by (source, raw name); unknown names drop."""
    keyed = df.withColumn("alias", channel_alias(raw))
    return keyed.join(channel_map, ["source", "alias"]).drop("alias")


def map_category(df: DataFrame, keywords: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """(key, raw, category) by a keyword table: the whole segment, else its first known word."""
    seg = category_segment(raw)
    words = F.array_distinct(F.concat(F.array(seg), F.split(seg, r"(?U)\s+")))
    terms = df.select(key, raw, F.posexplode_outer(words).alias("pos", "word"))
    hits = terms.join(keywords.withColumnRenamed("category", "_cat"), "word", "left")
    best = F.min_by("_cat", F.when(F.col("_cat").isNotNull(), F.col("pos")))
    return hits.groupBy(key, raw).agg(F.coalesce(best, F.lit("other")).alias("category"))


def original_document(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Upstream document of a material, null if its source has none."""
    docs = documents.select("source", "id", F.col("xml").alias("original_xml"))
    return requests.join(docs, ["source", "id"], "left")


def union_sources(*indexes: DataFrame) -> DataFrame:
    """Bag union of the indexes of several sources."""
    out = indexes[0]
    for other in indexes[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def all_sources(manifest_files: DataFrame, *extra: str) -> DataFrame:
    """Sources over all tiers plus the given ones (sources without textures), each once."""
    spark = manifest_files.sparkSession
    have = manifest_files.select("source")
    if extra:
        have = have.union(spark.createDataFrame([(s,) for s in extra], "source string"))
    return have.distinct()
