"""Manifests, snapshots, delta releases and their checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.names import category_of_rowmap, parse_asset_name, rowmap_name
from assetlake.session import keep

MATERIAL = ["source", "id"]


def parsed_assets(names: DataFrame, prefix: str = S.ASSET_PREFIX, categories=None) -> DataFrame:
    """(file_name, kind, source, tier, category, chunk) of the names that are assets."""
    parsed = parse_asset_name("file_name", prefix, categories)
    return (
        names.select("file_name", parsed.alias("p"))
        .filter("p is not null")
        .select("file_name", "p.kind", "p.source", "p.tier", "p.category", "p.chunk")
    )


def manifest_rollup(names: DataFrame, prefix: str = S.ASSET_PREFIX, categories=None) -> DataFrame:
    """(tier, source, parquet_files, rowmap_files), both sorted; a key without bundle drops.

    File names per source and tier are as many as bundles, which are large by construction.
    """
    assets = parsed_assets(names, prefix, categories)

    def of_kind(kind: str):
        return F.array_sort(
            F.collect_list(F.when(F.col("kind") == kind, F.col("file_name")))
        )

    rolled = assets.groupBy("tier", "source").agg(
        of_kind("bundle").alias("parquet_files"), of_kind("rowmap").alias("rowmap_files")
    )
    return rolled.filter(F.size("parquet_files") > 0)


def unpartitioned_assets(
    names: DataFrame, sources: list[str], tiers: list[str], prefix: str = S.ASSET_PREFIX
) -> DataFrame:
    """(tier, source, parquet_files, rowmap_files) of a bake output, for the given sources and tiers.

    Any category counts. The single unpartitioned file of a kind is used only where no partitioned
    one exists.
    """

    def alternatives(values: list[str]) -> str:
        return "|".join(re.escape(v) for v in sorted(values, key=len, reverse=True))

    cell = rf"({alternatives(sources)})-({alternatives(tiers)})(-.+)?"
    bundle = rf"^{re.escape(prefix)}-{cell}\.parquet$"
    rowmap = rf"^{cell}-rowmap\.json$"
    is_bundle = F.col("file_name").rlike(bundle)

    def group(i: int):
        return F.when(is_bundle, F.regexp_extract("file_name", bundle, i)).otherwise(
            F.regexp_extract("file_name", rowmap, i)
        )

    matched = names.filter(is_bundle | F.col("file_name").rlike(rowmap)).select(
        "file_name", is_bundle.alias("bundle"), group(1).alias("source"), group(2).alias("tier"),
        (group(3) != "").alias("parted"),
    )

    def files(kind):
        def of(parted):
            return F.array_sort(F.collect_list(F.when(kind & parted, F.col("file_name"))))

        many = of(F.col("parted"))
        return F.when(F.size(many) > 0, many).otherwise(of(~F.col("parted")))

    out = matched.groupBy("tier", "source").agg(
        files(F.col("bundle")).alias("parquet_files"), files(~F.col("bundle")).alias("rowmap_files")
    )
    return out.filter(F.size("parquet_files") > 0)


def manifest_document(
    rollup: DataFrame, release_tag: str, base_url: str, schema_version: int = 1
) -> DataFrame:
    """One row: the nested manifest as JSON (``content``). A tier is there only with a source."""
    sources = rollup.groupBy("tier").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct("source", F.struct("parquet_files", "rowmap_files")))
            )
        ).alias("sources")
    )
    tier = F.struct("tier", F.struct(F.lit(base_url).alias("base_url"), "sources"))
    # An aggregate without keys has one row even when there is no tier at all.
    tiers = sources.agg(F.map_from_entries(F.collect_list(tier)).alias("tiers"))
    head = [F.lit(schema_version).alias("schema_version"), F.lit(release_tag).alias("release_tag")]
    return tiers.select(
        F.lit("release-manifest.json").alias("file"),
        F.to_json(F.struct(*head, "tiers")).alias("content"),
    )


def categories(manifest_files: DataFrame) -> DataFrame:
    """Distinct category found in the rowmap names of a release."""
    names = manifest_files.filter("kind = 'rowmap'")
    return (
        names.select(category_of_rowmap("file_name").alias("category"))
        .filter("category is not null")
        .distinct()
    )


def diff_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, id, change): new, changed, unchanged or removed.

    Compares the sets of (channel, sha256) of two long texture tables; works on hashes only.
    """
    key = [*MATERIAL, "channel"]
    a = old.select(*key, F.col("sha256").alias("old_hash"))
    b = new.select(*key, F.col("sha256").alias("new_hash"))
    per_channel = a.join(b, key, "full_outer")
    flags = per_channel.groupBy(*MATERIAL).agg(
        F.count("old_hash").alias("n_old"),
        F.count("new_hash").alias("n_new"),
        F.count_if(~F.col("old_hash").eqNullSafe(F.col("new_hash"))).alias("n_diff"),
    )
    change = (
        F.when(F.col("n_old") == 0, "new")
        .when(F.col("n_new") == 0, "removed")
        .when(F.col("n_diff") > 0, "changed")
        .otherwise("unchanged")
    )
    return flags.select(*MATERIAL, change.alias("change"))


def diff_indexes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The same classification from the hash maps two indexes carry."""

    def digest(df: DataFrame, name: str) -> DataFrame:
        hashes = F.transform(F.map_entries("texture_hashes"), lambda e: F.struct(e["key"], e["value"]["sha256"]))
        folded = F.coalesce(F.to_json(F.array_sort(hashes)), F.lit("[]"))
        return df.select(*MATERIAL, folded.alias(name))

    both = digest(old, "o").join(digest(new, "n"), MATERIAL, "full_outer")
    change = (
        F.when(F.col("o").isNull(), "new")
        .when(F.col("n").isNull(), "removed")
        .when(F.col("o") != F.col("n"), "changed")
        .otherwise("unchanged")
    )
    return both.select(*MATERIAL, change.alias("change"))


def plan_refresh(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, id, change, action): bake new and changed, carry unchanged, tombstone removed."""
    action = (
        F.when(F.col("change").isin("new", "changed"), "bake")
        .when(F.col("change") == "unchanged", "carry")
        .otherwise("tombstone")
    )
    return diff_snapshots(old, new).withColumn("action", action)


def delta_manifest(
    plan: DataFrame, placed: DataFrame, release_tag: str, base_release: str
) -> DataFrame:
    """(release_tag, base_release, tier, source, file_name, from): files of a delta release.

    ``placed``: (source, id, tier, file_name) of the materials that stay. A file none of whose
    materials was baked is taken over from the base.
    """
    live = placed.join(plan.filter("action <> 'tombstone'"), MATERIAL)
    files = live.groupBy("tier", "source", "file_name").agg(
        F.bool_or(F.col("action") == "bake").alias("fresh")
    )
    origin = F.when(F.col("fresh"), F.lit(release_tag)).otherwise(base_release)
    return files.select(
        F.lit(release_tag).alias("release_tag"),
        F.lit(base_release).alias("base_release"),
        "tier", "source", "file_name", origin.alias("from"),
    )


def delta_document(files: DataFrame, plan: DataFrame, schema_version: int = 1) -> DataFrame:
    """(file, content): the delta manifest of each release of ``files`` as JSON.

    ``files`` as ``delta_manifest`` gives them, ``plan`` as ``plan_refresh`` does: what it takes out
    is listed under ``removed``. A bundle is ``{name, from}``, from the release that holds it.
    """
    head = ["release_tag", "base_release"]
    named = F.array_sort(F.collect_list(F.struct(F.col("file_name").alias("name"), "from")))
    sources = files.groupBy(*head, "tier", "source").agg(F.struct(named.alias("parquet_files")).alias("s"))
    by_source = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "s"))))
    tiers = sources.groupBy(*head, "tier").agg(F.struct("tier", by_source.alias("s")).alias("t"))
    gone = plan.filter("action = 'tombstone'").agg(
        F.array_sort(F.collect_list(F.struct(*MATERIAL))).alias("removed")
    )
    nested = tiers.groupBy(*head).agg(F.map_from_entries(F.collect_list("t")).alias("tiers"))
    body = F.struct(F.lit(schema_version).alias("schema_version"), *head, "tiers", gone.scalar().alias("removed"))
    return nested.select(
        F.concat("release_tag", F.lit("/release-manifest.json")).alias("file"), F.to_json(body).alias("content")
    )


def drop_tombstones(df: DataFrame, removed: DataFrame) -> DataFrame:
    return df.join(removed.select(*MATERIAL).distinct(), MATERIAL, "left_anti")


def release_chain(releases: DataFrame, tag: str) -> DataFrame:
    """(release_tag, depth) of a release and its bases, nearest first.

    ``releases``: (release_tag, base_release). Pointers to the ancestor 1, 2, 4, ... steps up are
    doubled, so a chain of n releases takes about log2(n) rounds, whatever its length. A cycle is an
    error, a base that does not exist ends the chain, an unknown ``tag`` has none.
    """
    known = releases.select(F.col("release_tag").alias("base_release"))
    up = releases.select("release_tag", "base_release").distinct().join(known.distinct(), "base_release")
    up = keep(up.select("release_tag", "base_release"), "bases")
    start = releases.filter(F.col("release_tag") == tag).select("release_tag").distinct()
    chain = keep(start.withColumn("depth", F.lit(0)), "chain")
    step = 1
    while True:
        above = chain.join(up, "release_tag").select(
            F.col("base_release").alias("release_tag"), (F.col("depth") + step).alias("depth")
        )
        longer = keep(chain.unionByName(above), "chain")
        rows, tags = longer.agg(F.count(F.lit(1)), F.count_distinct("release_tag")).first()
        if rows > tags:
            raise ValueError(f"the bases of {tag} form a cycle")
        if longer.filter(F.col("depth") >= step).isEmpty():
            return chain
        chain = longer
        far = up.select(F.col("release_tag").alias("base_release"), F.col("base_release").alias("far"))
        up = keep(up.join(far, "base_release").select("release_tag", F.col("far").alias("base_release")), "bases")
        step *= 2


def resolve_overlay(releases: DataFrame, files: DataFrame, tag: str) -> DataFrame:
    """(tier, source, file_name, from): every file seen from ``tag``, nearest release first."""
    return (
        files.join(release_chain(releases, tag), "release_tag")
        .groupBy("tier", "source", "file_name")
        .agg(F.min_by("release_tag", "depth").alias("from"))
    )


def flatten_release(
    releases: DataFrame, rows: DataFrame, removed: DataFrame, tag: str
) -> DataFrame:
    """All (source, id, …) rows of a release: the nearest version of a material that is not removed.

    ``rows`` and ``removed`` carry ``release_tag``. A tombstone hides versions of its own and of
    deeper releases; a nearer release may bring the material back.
    """
    chain = release_chain(releases, tag)
    nearest = rows.join(chain, "release_tag")
    gone = (
        removed.join(chain, "release_tag")
        .groupBy(*MATERIAL)
        .agg(F.min("depth").alias("gone_depth"))
    )
    data = [c for c in rows.columns if c not in MATERIAL]
    best = nearest.groupBy(*MATERIAL).agg(
        F.min("depth").alias("depth"), F.min_by(F.struct(*data), "depth").alias("r")
    )
    alive = F.col("gone_depth").isNull() | (F.col("depth") < F.col("gone_depth"))
    return best.join(gone, MATERIAL, "left").filter(alive).select(*MATERIAL, "r.*")


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(file_name, expected_size, actual_size, problem) of assets missing, extra or of wrong size."""
    e = expected.select("file_name", F.col("size").alias("expected_size"))
    a = actual.select("file_name", F.col("size").alias("actual_size"))
    problem = (
        F.when(F.col("actual_size").isNull(), "missing")
        .when(F.col("expected_size").isNull(), "unexpected")
        .when(F.col("actual_size") != F.col("expected_size"), "wrong_size")
    )
    both = e.join(a, "file_name", "full_outer").withColumn("problem", problem)
    return both.filter("problem is not null")


def missing_in_release(expected: DataFrame, actual: DataFrame) -> DataFrame:
    return expected.join(actual.select("file_name"), "file_name", "left_anti")


def gap_cells(names: DataFrame, expected: DataFrame, prefix: str = S.ASSET_PREFIX, categories=None):
    """(source, tier, category, missing): expected cells without a bundle or without a rowmap."""
    have = (
        parsed_assets(names, prefix, categories)
        .groupBy("source", "tier", "category")
        .agg(
            F.bool_or(F.col("kind") == "bundle").alias("b"),
            F.bool_or(F.col("kind") == "rowmap").alias("r"),
        )
    )
    cells = expected.select("source", "tier", "category").distinct()
    joined = cells.join(have, ["source", "tier", "category"], "left").fillna(False, ["b", "r"])
    missing = F.concat_ws(
        "+", F.when(~F.col("b"), F.lit("bundle")), F.when(~F.col("r"), F.lit("rowmap"))
    )
    return joined.select("source", "tier", "category", missing.alias("missing")).filter(
        "missing <> ''"
    )


def verify_hashes(hashed: DataFrame, index: DataFrame) -> DataFrame:
    """Textures whose sha256 or size differs from the index: (source, id, channel, problem)."""
    entry = index.select(*MATERIAL, F.explode("texture_hashes").alias("channel", "h")).select(
        *MATERIAL, "channel", F.col("h.sha256").alias("want"), F.col("h.size").alias("want_size")
    )
    problem = F.when(F.col("length") != F.col("want_size"), "size").when(
        F.col("sha256") != F.col("want"), "sha256"
    )
    return (
        hashed.join(entry, [*MATERIAL, "channel"])
        .withColumn("problem", problem)
        .filter("problem is not null")
        .select(*MATERIAL, "channel", "problem")
    )


def validate_release(
    manifest_files: DataFrame,
    rowmap: DataFrame,
    index: DataFrame,
    footers: DataFrame | None = None,
    prefix: str = S.ASSET_PREFIX,
    fetched: DataFrame | None = None,
) -> DataFrame:
    """(check, subject) for every breach between manifest, rowmaps, index, footers and bytes.

    ``fetched``: what ``fetch_ranges`` gives for the rowmap. Index and rowmap meet in one aggregate per material and tier; files are compared by name.
    """
    bundles = manifest_files.filter("kind = 'bundle'").select("file_name")
    rowmaps = manifest_files.filter("kind = 'rowmap'").select("file_name")
    wanted = bundles.withColumn("rowmap_file", rowmap_name("file_name", prefix))
    known = rowmap.select(F.col("parquet_file").alias("file_name")).distinct()

    def report(df: DataFrame, check: str, subject: str) -> DataFrame:
        return df.select(F.lit(check).alias("check"), F.col(subject).alias("subject"))

    checks = [
        report(
            wanted.join(
                rowmaps.withColumnRenamed("file_name", "rowmap_file"), "rowmap_file", "left_anti"
            ),
            "bundle_without_rowmap",
            "file_name",
        ),
        report(
            known.join(bundles, "file_name", "left_anti"),
            "rowmap_of_unknown_bundle",
            "file_name",
        ),
        material_breaches(rowmap, index),
    ]
    if footers is not None:
        ids = rowmap.select("parquet_file", "id").distinct().groupBy("parquet_file").count()
        groups = footers.groupBy("parquet_file").agg(F.max("n_row_groups").alias("g"))
        differ = groups.join(ids, "parquet_file", "left").filter("coalesce(count, 0) <> g")
        checks.append(report(differ, "row_groups_differ_from_rowmap", "parquet_file"))
    if fetched is not None:
        checks.append(range_breaches(fetched, index))
    return reduce(lambda a, b: a.unionByName(b), checks)


def range_breaches(fetched: DataFrame, index: DataFrame) -> DataFrame:
    """(check, subject): ranges that cannot be read, or whose bytes are not those of the index.

    Payloads are hashed where they are read; only hashes meet the index.
    """
    hashed = fetched.select(*MATERIAL, "tier", "channel", "error_kind", F.sha2("payload", 256).alias("sha256"))
    wanted = index.select(*MATERIAL, F.explode("texture_hashes").alias("channel", "h"))
    wanted = wanted.select(*MATERIAL, "channel", F.col("h.sha256").alias("want"))
    check = F.when(F.col("error_kind").isNotNull(), F.concat(F.lit("range_"), "error_kind")).when(
        F.col("sha256") != F.col("want"), "range_differs_from_index"
    )
    both = hashed.join(wanted, [*MATERIAL, "channel"], "left")
    subject = F.concat_ws("/", "source", "tier", "id", "channel")
    return both.select(check.alias("check"), subject.alias("subject")).filter("check is not null")


def material_breaches(rowmap: DataFrame, index: DataFrame) -> DataFrame:
    """(check, subject): materials, tiers and channels on which rowmap and index disagree."""
    entries = index.select(
        *MATERIAL, F.explode_outer("available_tiers").alias("tier"), "maps",
        F.lit(True).alias("in_index"),
    )
    ranges = rowmap.select(*MATERIAL, "tier", "channel", "parquet_file")
    both = entries.unionByName(ranges, allowMissingColumns=True)
    per_tier = both.groupBy(*MATERIAL, "tier").agg(
        F.coalesce(F.max("in_index"), F.lit(False)).alias("in_index"),
        F.max("maps").alias("maps"),
        F.collect_set("channel").alias("channels"),
        F.min("parquet_file").alias("lo"),
        F.max("parquet_file").alias("hi"),
    )
    name = F.concat_ws("/", "source", "tier", "id")
    in_tier = F.col("in_index") & F.col("tier").isNotNull()
    empty = F.array().cast("array<string>")

    def breach(check: str, subject):
        return F.struct(F.lit(check).alias("check"), subject.alias("subject"))

    absent = F.transform(
        F.when(in_tier, F.array_except("maps", "channels")).otherwise(empty),
        lambda c: breach("index_channel_without_range", F.concat(name, F.lit("/"), c)),
    )
    found = F.array_compact(
        F.array(
            F.when(F.col("lo") != F.col("hi"), breach("id_in_two_bundles", name)),
            F.when(in_tier & F.col("lo").isNull(), breach("index_tier_without_range", name)),
        )
    )
    by_tier = per_tier.select(F.explode(F.concat(found, absent)).alias("b")).select("b.*")
    unknown = (
        per_tier.groupBy(*MATERIAL)
        .agg(F.bool_or("in_index").alias("known"))
        .filter("not known")
        .select(
            F.lit("range_without_index_entry").alias("check"),
            F.concat_ws("/", *MATERIAL).alias("subject"),
        )
    )
    return by_tier.unionByName(unknown)
