"""Index, rowmap, manifest and release tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import normalize as N

Paths = str | list[str]


def read_index(spark: SparkSession, paths: Paths, multi_line: bool = True) -> DataFrame:
    """Index entries of all given files: JSON arrays, or one entry per line (splittable)."""
    return spark.read.json(paths, schema=S.INDEX_SCHEMA, multiLine=multi_line)


def read_index_table(spark: SparkSession, path: str) -> DataFrame:
    """Index kept as Parquet; filters and columns reach the scan."""
    return spark.read.parquet(path)


ROWMAP_HEAD = ["release_tag", "source", "tier", "parquet_file"]


def explode_rowmap(rowmaps: DataFrame, *extra: str) -> DataFrame:
    """Long rows (source, tier, parquet_file, id, channel, offset, length) of nested rowmaps."""
    head = [*ROWMAP_HEAD, *extra]
    mats = rowmaps.select(*head, F.explode("materials").alias("id", "channels"))
    return mats.select(*head, "id", F.explode("channels").alias("channel", "range")).select(
        *head, "id", "channel", "range.offset", "range.length"
    )


def read_rowmap(spark: SparkSession, paths: Paths) -> DataFrame:
    raw = spark.read.json(paths, schema=S.ROWMAP_SCHEMA, multiLine=True)
    return explode_rowmap(
        raw.withColumn("rowmap_file", F.col("_metadata.file_name")), "rowmap_file"
    )


def explode_manifest(manifest: DataFrame) -> DataFrame:
    """(release_tag, tier, base_url, source, kind, file_name); old single-rowmap entries too."""
    tiers = manifest.select("release_tag", F.explode("tiers").alias("tier", "t"))
    sources = tiers.select(
        "release_tag", "tier", "t.base_url", F.explode("t.sources").alias("source", "s")
    )
    many = F.col("s.rowmap_files")
    rowmaps = F.when(F.size(many) > 0, many).when(
        F.col("s.rowmap_file").isNotNull(), F.array("s.rowmap_file")
    )

    def tagged(files, kind: str):
        return F.transform(
            F.coalesce(files, F.array().cast("array<string>")),
            lambda f: F.struct(F.lit(kind).alias("kind"), f.alias("file_name")),
        )

    both = F.concat(tagged(F.col("s.parquet_files"), "bundle"), tagged(rowmaps, "rowmap"))
    return sources.select(
        "release_tag", "tier", "base_url", "source", F.explode(both).alias("f")
    ).select("release_tag", "tier", "base_url", "source", "f.kind", "f.file_name")


class UnknownSchemaVersion(ValueError):
    """The manifest declares no schema version or one this engine does not know."""


def require_schema_version(manifest: DataFrame, known: set[int] = frozenset({1})) -> DataFrame:
    """Refuse an unknown or missing version before any further job is planned."""
    ok = F.coalesce(F.col("schema_version").isin(*known), F.lit(False))
    bad = manifest.filter(~ok).select("schema_version").take(1)
    if bad:
        raise UnknownSchemaVersion(f"schema_version {bad[0][0]!r} is not one of {sorted(known)}")
    return manifest


def read_manifest(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.json(path, schema=S.MANIFEST_SCHEMA, multiLine=True)


def read_manifest_files(spark: SparkSession, path: Paths) -> DataFrame:
    return explode_manifest(require_schema_version(read_manifest(spark, path)))


def read_delta_manifests(spark: SparkSession, path: Paths) -> DataFrame:
    """One row per delta manifest; unknown schema versions are refused."""
    raw = spark.read.json(path, schema=S.DELTA_MANIFEST_SCHEMA, multiLine=True)
    return require_schema_version(raw)


def explode_delta(manifests: DataFrame) -> DataFrame:
    """(release_tag, base_release, tier, source, file_name, from) of delta manifests."""
    head = ["release_tag", "base_release"]
    tiers = manifests.select(*head, F.explode("tiers").alias("tier", "sources"))
    sources = tiers.select(*head, "tier", F.explode("sources").alias("source", "s"))
    files = sources.select(*head, "tier", "source", F.explode("s.parquet_files").alias("f"))
    return files.select(*head, "tier", "source", F.col("f.name").alias("file_name"), "f.from")


def removed_by(manifests: DataFrame) -> DataFrame:
    """(release_tag, source, id): tombstones of delta manifests."""
    return manifests.select("release_tag", F.explode("removed").alias("r")).select("release_tag", "r.*")


def latest_release(releases: DataFrame, tag: str = "release_tag") -> DataFrame:
    """One row with the newest well-formed calendar tag."""
    return releases.filter(N.release_tag_ok(tag)).agg(
        F.max_by(tag, N.release_order(tag)).alias(tag)
    )


def resolve_release(
    releases: DataFrame, tag: str | None = None, manifest: str | None = None
) -> str | None:
    """An explicit manifest wins over a tag, a tag over the newest release."""
    return manifest or tag or latest_release(releases).first()[0]


def resolve_releases(
    requests: DataFrame, releases: DataFrame, tag: str = "tag", manifest: str = "manifest"
) -> DataFrame:
    """Adds ``resolved`` to every request: its manifest, else its tag, else the newest release."""
    newest = latest_release(releases).scalar()
    return requests.withColumn("resolved", F.coalesce(manifest, tag, newest))


def newer_available(releases: DataFrame, current: str) -> DataFrame:
    """(latest, current, newer): whether the newest release differs from the one in use."""
    latest = latest_release(releases).withColumnRenamed("release_tag", "latest")
    return latest.select(
        "latest", F.lit(current).alias("current"), (F.col("latest") != current).alias("newer")
    )


def with_fallback(primary: DataFrame, *older: DataFrame, key: str = "source") -> DataFrame:
    """Per source, all rows of the first release that has the source at all."""
    tables = [d.withColumn("_release_no", F.lit(i)) for i, d in enumerate([primary, *older])]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    first = rows.groupBy(key).agg(F.min("_release_no").alias("_first"))
    return (
        rows.join(first, key)
        .filter(F.col("_release_no") == F.col("_first"))
        .drop("_release_no", "_first")
    )


