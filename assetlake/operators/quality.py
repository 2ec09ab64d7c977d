"""Rule checks; every breach is a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake import schemas as S
from assetlake.functions.json_schema import Rename, breaches, violations
from assetlake.operators.rowmap import overlaps
from assetlake.specs import index_schema, manifest_schema, rowmap_schema


#: Names of broken rules in the index that differ from ``<property>.<keyword>``.
INDEX_RULES = {
    **{f"{c}.required": f"missing_{c}" for c in S.INDEX_REQUIRED},
    **{f"{c}.minLength": f"empty_{c}" for c in ("id", "name", "source_license")},
    **{f"{c}.enum": f"{c}_enum" for c in ("source", "category", "status")},
    **{f"{c}.{k}": f"{c}_range" for c in ("roughness", "metalness", "ior") for k in ("minimum", "maximum")},
    "color_hex.pattern": "color_pattern",
    "available_tiers[].pattern": "tier_pattern",
    "available_tiers.uniqueItems": "tiers_unique",
    "maps[].enum": "maps_enum",
    "maps.uniqueItems": "maps_unique",
    "texture_hashes.propertyNames.enum": "hash_channel",
    **{f"texture_hashes.*.{c}.{k}": "hash_shape" for c in ("sha256", "size") for k in ("required", "pattern", "minimum")},
    "last_updated.format": "last_updated_date",
}
ROWMAP_RULES = {
    **{f"{c}.required": f"missing_{c}" for c in ("source", "tier", "parquet_file")},
    **{f"release_tag.{k}": "release_tag_pattern" for k in ("required", "pattern")},
    "source.enum": "source_enum",
    "materials.*.minProperties": "no_channel",
    "materials.*.propertyNames.enum": "channel_enum",
    **{f"materials.*.*.{c}.{k}": f"{c}_range" for c in ("offset", "length") for k in ("required", "minimum")},
}
MANIFEST_RULES = {
    **{f"schema_version.{k}": "schema_version" for k in ("required", "enum")},
    **{f"release_tag.{k}": "release_tag_pattern" for k in ("required", "pattern")},
    "tiers.required": "missing_tiers",
    **{f"tiers.*.base_url.{k}": "missing_base_url" for k in ("required", "minLength")},
    **{f"tiers.*.sources.{k}": "missing_sources" for k in ("required", "minProperties")},
    **{f"tiers.*.sources.*.parquet_files.{k}": "no_bundle" for k in ("required", "minItems")},
    "tiers.*.sources.*.anyOf": "no_rowmap",
}


def _named(rules: dict[str, str]) -> Rename:
    return lambda rule: rules.get(rule, rule)


def _broken_rules(df: DataFrame, schema: dict, keys: list[str], rules: dict[str, str], columns: list[str]) -> DataFrame:
    """(keys, rule), each rule once per row. ``columns`` are those that the schema speaks of."""
    described = T.StructType([df.schema[c] for c in columns if c in df.columns])
    found = F.transform(breaches(schema, described, _named(rules)), lambda b: b["rule"])
    return df.select(*keys, F.explode(F.array_distinct(found)).alias("rule"))


def check_index(
    index: DataFrame,
    sources: list[str] | None = None,
    categories: list[str] | None = None,
    schema: dict | None = None,
) -> DataFrame:
    """(source, id, rule, severity) of index entries that break ``schema``, by default that of the index.

    A malformed ``last_updated`` is a warning, everything else an error. Names that are no string of
    ``INDEX_RULES`` are those of the property and the keyword.
    """
    schema = schema or index_schema(sources, categories)
    found = _broken_rules(index, schema, ["source", "id"], INDEX_RULES, index.columns)
    dup = index.groupBy("source", "id").count().filter("count > 1 and id is not null")
    both = found.unionByName(dup.select("source", "id", F.lit("duplicate_id").alias("rule")))
    severity = F.when(F.col("rule") == "last_updated_date", "warning").otherwise("error")
    return both.withColumn("severity", severity)


def check_rowmap(rowmap: DataFrame, sources: list[str] | None = None, schema: dict | None = None) -> DataFrame:
    """(parquet_file, id, channel, rule) of long rowmap rows that break the schema of rowmaps or overlap.

    Each row is checked as a document of one material and one channel; a material without a channel
    comes as a row with a null channel.
    """
    keys = ["parquet_file", "id", "channel"]
    place = F.struct("offset", "length")
    channel = F.create_map(F.coalesce("channel", F.lit("")), place)
    channels = F.when(F.col("channel").isNotNull(), channel).otherwise(F.map_filter(channel, lambda k, v: F.lit(False)))
    documents = rowmap.withColumns(
        {"version": F.lit(1), "materials": F.create_map(F.coalesce("id", F.lit("")), channels)}
    )
    described = ["version", "release_tag", "source", "tier", "parquet_file", "materials"]
    broken = _broken_rules(documents, schema or rowmap_schema(sources), keys, ROWMAP_RULES, described)
    laid_out = rowmap.filter("offset is not null and length is not null")
    return broken.unionByName(
        overlaps(laid_out).select(*keys, F.lit("overlap").alias("rule"))
    )


def check_rowmap_documents(documents: DataFrame, schema: dict | None = None) -> DataFrame:
    """(parquet_file, subject, rule) of nested rowmaps as files hold them; ``subject`` is the material and channel."""
    rules = {**ROWMAP_RULES, "version.required": "version", "version.const": "version"}
    return violations(documents, schema or rowmap_schema(), ["parquet_file"], _named(rules))


def check_manifest(manifest: DataFrame, known: tuple[int, ...] = (1,), schema: dict | None = None) -> DataFrame:
    """(release_tag, subject, rule) of nested manifests that break their schema; ``subject`` is the tier and source."""
    return violations(manifest, schema or manifest_schema(known), ["release_tag"], _named(MANIFEST_RULES))


def status_summary(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """ok, failed and total per source."""
    ok = F.coalesce("status", F.lit("ok")) == "ok"
    return records.groupBy(*(by or ["source"])).agg(
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def success_gate(
    records: DataFrame, min_success: float = 0.95, by: list[str] | None = None
) -> DataFrame:
    """Summary plus ``share`` and ``passed``. ``min_success`` 0 asks for one success only."""
    out = status_summary(records, by).withColumn("share", F.col("ok") / F.col("total"))
    passed = F.col("ok") > 0 if min_success <= 0 else F.col("share") >= min_success
    return out.withColumn("passed", passed)


class GateFailed(RuntimeError):
    """Too few materials succeeded."""


def require_success(records: DataFrame, min_success: float = 0.95) -> None:
    bad = success_gate(records, min_success).filter("not passed").take(5)
    if bad:
        raise GateFailed("; ".join(f"{r['source']}: {r['ok']} of {r['total']} ok" for r in bad))


# A relative path escapes when, at any point, it has left more folders than it has entered.
def escapes_root(member: Column) -> Column:
    """The normalised member path would lie outside the folder it is extracted to."""
    parts = F.filter(F.split(member, "/"), lambda p: (p != "") & (p != "."))
    depth = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("low")),
        lambda a, p: F.struct(
            (a["now"] + F.when(p == "..", -1).otherwise(1)).alias("now"),
            F.least(a["low"], a["now"] + F.when(p == "..", -1).otherwise(1)).alias("low"),
        ),
        lambda a: a["low"],
    )
    climbs = F.contains(member, F.lit("..")) & (depth < 0)
    return F.startswith(member, F.lit("/")) | climbs


def archive_safety(
    members: DataFrame,
    max_total: int = S.ARCHIVE_MAX_TOTAL,
    max_file: int = S.ARCHIVE_MAX_FILE,
    max_ratio: float = S.ARCHIVE_MAX_RATIO,
    check_paths: bool = True,
) -> DataFrame:
    """Per archive: members, total, largest, ratio and the first ``violation`` (null if safe)."""
    escape = escapes_root(F.col("member")) if check_paths else F.lit(False)
    unreadable = F.col("error").isNotNull() if "error" in members.columns else F.lit(False)
    per = members.groupBy("archive").agg(
        F.count("member").alias("members"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
        F.coalesce(F.max("size"), F.lit(0)).alias("largest"),
        F.coalesce(F.sum("compressed"), F.lit(0)).alias("compressed"),
        F.bool_or(F.coalesce(escape, F.lit(False))).alias("_escape"),
        F.bool_or(unreadable).alias("_unreadable"),
    )
    ratio = F.when(F.col("compressed") > 0, F.col("total") / F.col("compressed"))
    violation = (
        F.when(F.col("_unreadable"), "unreadable")
        .when(F.col("_escape"), "path_escape")
        .when(F.col("largest") > max_file, "file_too_large")
        .when(F.col("total") > max_total, "total_too_large")
        .when(ratio > max_ratio, "ratio_too_high")
    )
    return per.withColumns({"ratio": ratio, "violation": violation}).drop("_escape", "_unreadable")


def safe_members(members: DataFrame, **limits) -> DataFrame:
    """Members of the archives without a violation."""
    bad = archive_safety(members, **limits).filter("violation is not null").select("archive")
    return members.join(bad, "archive", "left_anti")


def content_duplicates(hashed: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows whose sha256 occurs under more than one key, with ``copies`` and the first key.

    A group of copies may be of any size, so it stays long: one row per copy.
    """
    key = key or ["source", "id", "channel"]
    distinct = hashed.select("sha256", *key).distinct()
    groups = distinct.groupBy("sha256").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*key)).alias("first")
    )
    return distinct.join(groups.filter("copies > 1"), "sha256")
