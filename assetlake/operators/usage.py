"""Storage accounting, retention and run figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S


def parse_inventory(files: DataFrame) -> DataFrame:
    """(file, length) -> (tag, source, tier, id, channel, is_meta, file, length).

    Payloads lie at ``tag/source/tier/id/channel.png``; names starting with a dot, alone or below
    the tag, are metadata.
    """
    parts = F.split("file", "/")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    meta = F.startswith(first, F.lit(".")) | F.coalesce(
        F.startswith(second, F.lit(".")), F.lit(False)
    )

    def part(i: int) -> Column:
        return F.when(~meta, F.get(parts, F.lit(i)))

    return files.select(
        F.when(~F.startswith(first, F.lit(".")), first).alias("tag"),
        part(1).alias("source"),
        part(2).alias("tier"),
        part(3).alias("id"),
        F.regexp_replace(part(4), r"\.[^.]*$", "").alias("channel"),
        meta.alias("is_meta"),
        "file",
        "length",
    )


def storage_usage(inventory: DataFrame) -> DataFrame:
    """(scope, tag, source, tier, bytes, files) per cell, for metadata and in total."""
    rows = inventory.select("tag", "source", "tier", "is_meta", "length")
    sets = rows.groupingSets(
        [["tag", "source", "tier", "is_meta"], ["is_meta"], []], "tag", "source", "tier", "is_meta"
    ).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"),
        F.grouping_id().alias("g"),
    )
    scope = (
        F.when(F.col("g") == 15, "total")
        .when((F.col("g") == 14) & F.col("is_meta"), "meta")
        .when((F.col("g") == 0) & ~F.col("is_meta"), "cell")
    )
    return (
        sets.withColumn("scope", scope)
        .filter("scope is not null")
        .select("scope", "tag", "source", "tier", "bytes", "files")
    )


def over_cap(inventory: DataFrame, cap: int = S.CACHE_SOFT_CAP) -> DataFrame:
    """One row (bytes, cap, over); a cap of 0 switches the test off."""
    total = F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    over = F.lit(False) if cap <= 0 else F.col("bytes") > cap
    return inventory.agg(total).withColumns(
        {"cap": F.lit(cap).cast("long"), "over": over}
    )


def retention_plan(
    inventory: DataFrame,
    keep_tags: list[str] | None = None,
    tag: str | None = None,
    source: str | None = None,
    tier: str | None = None,
) -> DataFrame:
    """Files to delete: of tags not kept, of one tag, or payloads of a source and/or tier."""
    tests = []
    if keep_tags:
        tests.append(F.col("tag").isNotNull() & ~F.col("tag").isin(keep_tags))
    if tag:
        tests.append(F.col("tag") == tag)
    if source or tier:
        cell = ~F.col("is_meta")
        if source:
            cell = cell & (F.col("source") == source)
        if tier:
            cell = cell & (F.col("tier") == tier)
        tests.append(cell)
    if not tests:
        return inventory.filter(F.lit(False))
    return inventory.filter(F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)))


def bytes_freed(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def throughput(log: DataFrame, by: list[str]) -> DataFrame:
    """Materials, bytes, seconds and materials per second of each run.

    ``log``: (by, ts, ok, bytes). At least a tenth of a second is assumed.
    """
    seconds = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(
        F.min("ts").cast("timestamp")
    )
    out = log.groupBy(*by).agg(
        F.count_if("ok").alias("ok"),
        F.count(F.lit(1)).alias("total"),
        F.sum("bytes").alias("bytes"),
        (seconds / F.lit(1e6)).alias("seconds"),
    )
    return out.withColumn("per_second", F.col("ok") / F.greatest("seconds", F.lit(0.1)))


def count_by(index: DataFrame) -> DataFrame:
    """Materials per source and category."""
    return index.groupBy("source", "category").count().orderBy("source", "category")


def tier_union(index: DataFrame) -> DataFrame:
    """(source, tiers): sorted distinct tiers of a source."""
    pairs = index.select("source", F.explode("available_tiers").alias("tier")).distinct()
    return pairs.groupBy("source").agg(F.array_sort(F.collect_list("tier")).alias("tiers"))


def catalog_totals(index: DataFrame, manifest_files: DataFrame) -> DataFrame:
    """One row (materials, sources, tiers)."""
    tiers = manifest_files.agg(F.countDistinct("tier")).scalar()
    totals = index.agg(
        F.count(F.lit(1)).alias("materials"), F.countDistinct("source").alias("sources")
    )
    return totals.withColumn("tiers", tiers)


def coverage_matrix(files: DataFrame, tiers: list[str]) -> DataFrame:
    """Bundles per source (rows) and tier (columns)."""
    return files.groupBy("source").pivot("tier", tiers).count().fillna(0)


def merge_index(entries: DataFrame, version: str = "release_tag") -> DataFrame:
    """One entry per (source, id): newest metadata, union of tiers and maps.

    Tiers and maps come from small enumerations, so their distinct sets stay small.
    """
    key = ["source", "id"]
    arrays = ["available_tiers", "maps"]
    rest = [c for c in entries.columns if c not in [*key, *arrays]]
    newest = entries.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.col(version)).alias("r"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(a)))).alias(a) for a in arrays],
    )
    return newest.select(*key, "r.*", *arrays)


def physical_link(index: DataFrame, families: DataFrame, finishes: list[str]) -> DataFrame:
    """Soft tags of appearances: (source, id, physical_family, finish).

    ``families``: (word, physical_family). Words come from tags and name; the family is that of
    the first known word, the finish the first known finish.
    """
    words = F.transform(
        F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.split("name", r"\s+")),
        F.lower,
    )
    terms = index.select("source", "id", F.posexplode(words).alias("pos", "word"))
    hits = terms.join(families, "word", "left")
    known = F.col("word").isin(finishes)
    return hits.groupBy("source", "id").agg(
        F.min_by("physical_family", F.when(F.col("physical_family").isNotNull(), F.col("pos")))
        .alias("physical_family"),
        F.min_by("word", F.when(known, F.col("pos"))).alias("finish"),
    )


def resolve_physical(links: DataFrame, family: str, finish: str | None = None) -> DataFrame:
    """Appearances of a physical family, optionally of one finish."""
    out = links.filter(F.col("physical_family") == family)
    return out if finish is None else out.filter(F.col("finish") == finish)
