"""File names, manifests, snapshots and delta releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.names import rowmap_name
from assetlake.functions.normalize import lookup
from assetlake.operators import quality as Q
from assetlake.operators import releases as R
from assetlake.operators import usage as U
from assetlake.queries.registry import (
    asset_names,
    manifest_files,
    mat,
    query,
    rowmap,
    snapshots,
    sql_map,
    table,
    tex,
)
from assetlake.session import run_dir
from assetlake.sinks.files import write_files
from assetlake.sources import metadata


@query(
    "parse_asset_names",
    "SELECT file_name, kind, source, tier, category, chunk FROM parsed",
    "parsed",
)
def parse_asset_names(spark, d):
    return R.parsed_assets(asset_names(spark, d))


@query(
    "rowmap_name",
    """
    SELECT file_name, replace(replace(file_name, 'assetlake-', ''), '.parquet', '') || '-rowmap.json'
      AS rowmap_file FROM parsed WHERE kind = 'bundle'""",
    "parsed",
)
def rowmap_names(spark, d):
    bundles = R.parsed_assets(asset_names(spark, d)).filter("kind = 'bundle'")
    return bundles.select("file_name", rowmap_name("file_name").alias("rowmap_file"))


ROLLUP_SQL = """
  SELECT tier, source,
    string_agg(file_name, ',' ORDER BY file_name) FILTER (WHERE kind = 'bundle') AS parquet_files,
    coalesce(string_agg(file_name, ',' ORDER BY file_name) FILTER (WHERE kind = 'rowmap'), '')
      AS rowmap_files
  FROM parsed GROUP BY tier, source HAVING count(*) FILTER (WHERE kind = 'bundle') > 0"""


@query("manifest_rollup", ROLLUP_SQL, "parsed")
def manifest_rollup(spark, d):
    out = R.manifest_rollup(asset_names(spark, d))
    return out.withColumns({c: F.array_join(c, ",") for c in ("parquet_files", "rowmap_files")})


@query(
    "unpartitioned_assets",
    """
    SELECT tier, source,
      CASE WHEN many IS NOT NULL THEN many ELSE one END AS parquet_files, coalesce(rows, '') AS rowmap_files
    FROM (SELECT tier, source,
        string_agg(file_name, ',' ORDER BY file_name) FILTER (WHERE kind = 'part') AS many,
        string_agg(file_name, ',' ORDER BY file_name) FILTER (WHERE kind = 'one') AS one,
        string_agg(file_name, ',' ORDER BY file_name) FILTER (WHERE kind = 'map') AS rows
      FROM (SELECT file_name, tier, source, CASE kind WHEN 'bundle' THEN 'part' ELSE 'map' END AS kind
          FROM parsed WHERE source IN ('src1', 'src2') AND tier IN ('1k', '2k')
        UNION ALL SELECT 'assetlake-' || p_type || '-1k.parquet', '1k', p_type, 'one'
          FROM part WHERE p_type IN ('LARGE', 'SMALL') GROUP BY ALL)
      GROUP BY tier, source)""",
    "parsed",
)
def unpartitioned_assets(spark, d):
    singles = table(spark, d, "part").select(
        F.format_string("assetlake-%s-1k.parquet", "p_type").alias("file_name")
    )
    names = asset_names(spark, d).union(singles.distinct())
    out = R.unpartitioned_assets(names, ["src1", "src2", "LARGE", "SMALL"], ["1k", "2k"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("parquet_files", "rowmap_files")})


@query(
    "manifest_document",
    """
    SELECT 'release-manifest.json' AS file, 'v2026.04.0' AS release_tag, tier, source, file_name
    FROM parsed WHERE (tier, source) IN (SELECT (tier, source) FROM parsed WHERE kind = 'bundle')""",
    "parsed",
)
def manifest_document(spark, d):
    doc = R.manifest_document(
        R.manifest_rollup(asset_names(spark, d)), "v2026.04.0", "https://example.org/r/"
    )
    parsed = doc.withColumn("m", F.from_json("content", S.MANIFEST_SCHEMA))
    rows = parsed.select("file", "m.release_tag", F.explode(R_files("m")).alias("f"))
    return rows.select("file", "release_tag", "f.*")


def R_files(m: str):
    """All (tier, source, file) entries of a parsed manifest."""
    per_tier = F.transform(
        F.map_entries(f"{m}.tiers"),
        lambda t: F.flatten(
            F.transform(
                F.map_entries(t["value"]["sources"]),
                lambda s: F.transform(
                    F.concat(s["value"]["parquet_files"], s["value"]["rowmap_files"]),
                    lambda f: F.struct(
                        t["key"].alias("tier"), s["key"].alias("source"), f.alias("file_name")
                    ),
                ),
            )
        ),
    )
    return F.flatten(per_tier)


@query(
    "read_manifest",
    """
    SELECT 'v2026.04.0' AS release_tag, tier, 'https://example.org/r/' AS base_url, source, kind,
      file_name FROM parsed
    WHERE (tier, source) IN (SELECT (tier, source) FROM parsed WHERE kind = 'bundle')""",
    "parsed",
)
def read_manifest(spark, d):
    path = run_dir(spark, "manifest")
    rollup = R.manifest_rollup(asset_names(spark, d))
    write_files(R.manifest_document(rollup, "v2026.04.0", "https://example.org/r/"), path)
    return metadata.read_manifest_files(spark, path)


@query(
    "categories",
    "SELECT DISTINCT category FROM parsed WHERE kind = 'rowmap'",
    "parsed",
)
def categories(spark, d):
    return R.categories(R.parsed_assets(asset_names(spark, d)).select("kind", "file_name"))


@query(
    "coverage_matrix",
    """
    SELECT source, count(*) FILTER (WHERE tier = '1k') AS "1k", count(*) FILTER (WHERE tier = '2k') AS "2k",
      count(*) FILTER (WHERE tier = 'ktx2-1k') AS "ktx2-1k" FROM parsed WHERE kind = 'bundle'
    GROUP BY source""",
    "parsed",
)
def coverage_matrix(spark, d):
    bundles = R.parsed_assets(asset_names(spark, d)).filter("kind = 'bundle'")
    return U.coverage_matrix(bundles, ["1k", "2k", "ktx2-1k"])


@query(
    "gap_cells",
    """
    SELECT c.source, c.tier, c.category, concat_ws('+', CASE WHEN coalesce(b, 0) = 0 THEN 'bundle' END,
      CASE WHEN coalesce(r, 0) = 0 THEN 'rowmap' END) AS missing
    FROM (SELECT * FROM (SELECT DISTINCT source FROM documents), (VALUES ('1k'), ('2k')) t(tier),
        (VALUES ('other'), ('metal'), ('glass')) k(category)) c
    LEFT JOIN (SELECT source, tier, category, count(*) FILTER (WHERE kind = 'bundle') AS b,
        count(*) FILTER (WHERE kind = 'rowmap') AS r FROM parsed GROUP BY ALL) p
      USING (source, tier, category)
    WHERE coalesce(b, 0) = 0 OR coalesce(r, 0) = 0""",
    "parsed",
)
def gap_cells(spark, d):
    sources = table(spark, d, "documents").select("source").distinct()
    cells = sources.select(
        "source", F.explode(F.array(F.lit("1k"), F.lit("2k"))).alias("tier")
    ).select("*", F.explode(F.array(*[F.lit(c) for c in ("other", "metal", "glass")])).alias("category"))
    return R.gap_cells(asset_names(spark, d), cells)


# --- snapshots -----------------------------------------------------------------------------


@query("diff_snapshots", "SELECT source, id, change FROM diff", "diff")
def diff_snapshots(spark, d):
    return R.diff_snapshots(*snapshots(spark, d))


@query("diff_indexes", "SELECT source, id, change FROM diff", "diff")
def diff_indexes(spark, d):
    from assetlake.operators.select import texture_hashes

    old, new = (
        texture_hashes(s.withColumn("length", F.lit(1).cast("long")), ["source", "id"])
        for s in snapshots(spark, d)
    )
    return R.diff_indexes(old, new)


@query(
    "plan_refresh",
    """
    SELECT source, id, change, CASE change WHEN 'unchanged' THEN 'carry' WHEN 'removed' THEN 'tombstone'
      ELSE 'bake' END AS action FROM diff""",
    "diff",
)
def plan_refresh(spark, d):
    return R.plan_refresh(*snapshots(spark, d))


@query(
    "delta_manifest",
    """
    SELECT 'v2026.05.0' AS release_tag, 'v2026.04.0' AS base_release, '1k' AS tier, source, file_name,
      CASE WHEN bool_or(change IN ('new', 'changed')) THEN 'v2026.05.0' ELSE 'v2026.04.0' END AS "from"
    FROM (SELECT d.*, 'f' || CAST(CAST(id AS BIGINT) // 5 AS VARCHAR) AS file_name FROM diff d)
    WHERE change <> 'removed' GROUP BY source, file_name""",
    "diff",
)
def delta_manifest(spark, d):
    plan = R.plan_refresh(*snapshots(spark, d))
    file = F.concat(F.lit("f"), F.floor(F.col("id").cast("long") / 5).cast("string"))
    placed = tex(spark, d).select("source", "id", "tier", file.alias("file_name")).distinct()
    return R.delta_manifest(plan, placed, "v2026.05.0", "v2026.04.0")


DELTA_SQL = """
    SELECT 'v2026.05.0' AS release_tag, 'v2026.04.0' AS base_release, '1k' AS tier, source, file_name,
      CASE WHEN bool_or(change IN ('new', 'changed')) THEN 'v2026.05.0' ELSE 'v2026.04.0' END AS "from"
    FROM (SELECT d.*, 'f' || CAST(CAST(id AS BIGINT) // 5 AS VARCHAR) AS file_name FROM diff d)
    WHERE change <> 'removed' GROUP BY source, file_name"""


def delta_manifests(spark, d):
    """The delta release of ``delta_manifest``, written as a file and read back."""
    path = run_dir(spark, "delta")
    plan = R.plan_refresh(*snapshots(spark, d))
    write_files(R.delta_document(delta_manifest(spark, d), plan), path)
    return metadata.read_delta_manifests(spark, f"{path}/*/release-manifest.json")


@query("delta_document", DELTA_SQL, "diff")
def delta_document(spark, d):
    return metadata.explode_delta(delta_manifests(spark, d))


@query(
    "delta_removed",
    "SELECT 'v2026.05.0' AS release_tag, source, id FROM diff WHERE change = 'removed'",
    "diff",
)
def delta_removed(spark, d):
    return metadata.removed_by(delta_manifests(spark, d))


@query(
    "drop_tombstones",
    """
    SELECT source, id, channel, sha256 FROM snap_old
    WHERE (source, id) NOT IN (SELECT (source, id) FROM diff WHERE change = 'removed')""",
    "diff",
)
def drop_tombstones(spark, d):
    old, new = snapshots(spark, d)
    removed = R.diff_snapshots(old, new).filter("change = 'removed'")
    return R.drop_tombstones(old, removed)


# Each order date is a release based on the one before it; orders are its files.
CHAIN_SQL = """
  , days AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS release_tag FROM orders),
  rel AS (SELECT release_tag, lag(release_tag) OVER (ORDER BY release_tag) AS base_release FROM days),
  chain AS (
    SELECT release_tag, base_release, 0 AS depth FROM rel WHERE release_tag = '2000'
    UNION ALL
    SELECT r.release_tag, r.base_release, c.depth + 1
    FROM chain c JOIN rel r ON r.release_tag = c.base_release),
  vers AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS release_tag, 's' AS source,
      CAST(o_custkey AS VARCHAR) AS id, max(o_orderkey) AS payload_no,
      max(o_orderstatus) AS status FROM orders GROUP BY ALL)"""


def year_releases(spark, d):
    """(releases, versions): one release per year, its materials are the customers that ordered."""
    from pyspark.sql import Window

    o = table(spark, d, "orders").withColumn(
        "release_tag", F.date_format("o_orderdate", "yyyy")
    )
    years = o.select("release_tag").distinct()
    releases = years.withColumn(
        "base_release", F.lag("release_tag").over(Window.orderBy("release_tag"))
    )
    versions = o.groupBy(
        "release_tag", F.lit("s").alias("source"), F.col("o_custkey").cast("string").alias("id")
    ).agg(F.max("o_orderkey").alias("payload_no"), F.max("o_orderstatus").alias("status"))
    return releases, versions


@query(
    "release_chain",
    "WITH RECURSIVE one AS (SELECT 1)" + CHAIN_SQL + " SELECT release_tag, depth FROM chain",
)
def release_chain(spark, d):
    return R.release_chain(year_releases(spark, d)[0], "2000")


@query(
    "resolve_overlay",
    "WITH RECURSIVE one AS (SELECT 1)" + CHAIN_SQL + """
    SELECT '1k' AS tier, source, id AS file_name, arg_min(release_tag, depth) AS "from"
    FROM vers JOIN chain USING (release_tag) GROUP BY source, id""",
)
def resolve_overlay(spark, d):
    releases, versions = year_releases(spark, d)
    files = versions.select(
        "release_tag", "source", F.lit("1k").alias("tier"), F.col("id").alias("file_name")
    )
    return R.resolve_overlay(releases, files, "2000")


@query(
    "flatten_release",
    "WITH RECURSIVE one AS (SELECT 1)" + CHAIN_SQL + """
    , best AS (SELECT source, id, arg_min(release_tag, depth) AS release_tag, min(depth) AS depth
      FROM vers JOIN chain USING (release_tag) GROUP BY source, id),
    gone AS (SELECT source, id, min(depth) AS gone_depth FROM vers JOIN chain USING (release_tag)
      WHERE status = 'F' GROUP BY source, id)
    SELECT b.source, b.id, b.release_tag, v.payload_no
    FROM best b JOIN vers v USING (source, id, release_tag) LEFT JOIN gone USING (source, id)
    WHERE gone_depth IS NULL OR b.depth < gone_depth""",
)
def flatten_release(spark, d):
    """Customers whose orders of a year are all filled are tombstones of that year."""
    releases, versions = year_releases(spark, d)
    removed = versions.filter("status = 'F'").select("release_tag", "source", "id")
    return R.flatten_release(
        releases, versions.drop("status"), removed, "2000"
    ).select("source", "id", "release_tag", "payload_no")


# --- checks --------------------------------------------------------------------------------


@query(
    "reconcile",
    """
    SELECT * FROM (SELECT file_name, e.size AS expected_size, a.size AS actual_size,
        CASE WHEN a.size IS NULL THEN 'missing' WHEN e.size IS NULL THEN 'unexpected'
          WHEN a.size <> e.size THEN 'wrong_size' END AS problem
      FROM (SELECT 'd' || doc_id AS file_name, n_chars AS size FROM documents WHERE lang <> 'es') e
      FULL JOIN (SELECT 'd' || doc_id AS file_name, octet_length(encode(text)) AS size FROM documents
        WHERE lang <> 'de') a USING (file_name)) WHERE problem IS NOT NULL""",
)
def reconcile(spark, d):
    """Expected sizes are counted in characters, actual ones in bytes; each side lacks a language."""
    docs = table(spark, d, "documents").withColumn("file_name", F.concat(F.lit("d"), "doc_id"))
    expected = docs.filter("lang <> 'es'").select("file_name", F.col("n_chars").alias("size"))
    actual = docs.filter("lang <> 'de'").select(
        "file_name", F.octet_length("text").cast("long").alias("size")
    )
    return R.reconcile(expected, actual)


@query(
    "missing_in_release",
    "SELECT 'd' || doc_id AS file_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def missing_in_release(spark, d):
    name = F.concat(F.lit("d"), "doc_id").alias("file_name")
    return R.missing_in_release(
        table(spark, d, "documents").select(name), table(spark, d, "labels").select(name)
    )


TEXTURED = {"ECONOMY": "ambientcg", "LARGE": "polyhaven", "MEDIUM": "gpuopen"}


@query(
    "validate_release",
    """
    , bad AS (SELECT *, CASE WHEN channel = 'normal' AND length > 5000 THEN
        replace(parquet_file, '.parquet', '-9.parquet') ELSE parquet_file END AS file FROM rowmap),
    idx AS (SELECT source, id, available_tiers, maps FROM mat WHERE len(available_tiers) > 0
      AND (source, id) IN (SELECT (source, id) FROM tex) OR source = 'gpuopen')
    SELECT 'bundle_without_rowmap' AS check, 'assetlake-x-1k-wood.parquet' AS subject
    UNION ALL SELECT DISTINCT 'rowmap_of_unknown_bundle', file FROM bad WHERE file LIKE '%-9.parquet'
    UNION ALL SELECT 'id_in_two_bundles', source || '/' || tier || '/' || id FROM bad
      GROUP BY source, tier, id HAVING count(DISTINCT file) > 1
    UNION ALL SELECT 'index_tier_without_range', source || '/' || tier || '/' || id
      FROM (SELECT source, id, unnest(available_tiers) AS tier FROM idx)
      WHERE (source, tier, id) NOT IN (SELECT (source, tier, id) FROM tex)
    UNION ALL SELECT DISTINCT 'range_without_index_entry', source || '/' || id FROM tex
      WHERE (source, id) NOT IN (SELECT (source, id) FROM idx)
    UNION ALL SELECT 'index_channel_without_range', source || '/' || tier || '/' || id || '/' || channel
      FROM (SELECT source, id, tier, unnest(maps) AS channel FROM
        (SELECT source, id, maps, unnest(available_tiers) AS tier FROM idx))
      WHERE (source, tier, id, channel) NOT IN (SELECT (source, tier, id, channel) FROM tex)""",
    "mat", "rowmap",
)
def validate_release(spark, d):
    """Long normal maps are moved to a file the manifest does not know; one bundle has no rowmap."""
    moved = (F.col("channel") == "normal") & (F.col("length") > 5000)
    other = F.regexp_replace("parquet_file", r"\.parquet$", "-9.parquet")
    bad = rowmap(spark, d).withColumn(
        "parquet_file", F.when(moved, other).otherwise(F.col("parquet_file"))
    )
    extra = spark.createDataFrame(
        [("v2026.04.0", "1k", "", "x", "bundle", "assetlake-x-1k-wood.parquet")],
        manifest_files(spark, d).schema,
    )
    files = manifest_files(spark, d).unionByName(extra)
    known = rowmap(spark, d).select("source", "id").distinct()
    index = mat(spark, d)
    tiered = index.join(known, ["source", "id"], "left_semi").filter("size(available_tiers) > 0")
    rest = index.filter("source = 'gpuopen'").join(tiered.select("source", "id"), ["source", "id"], "left_anti")
    return R.validate_release(files, bad, tiered.unionByName(rest))


@query(
    "check_manifest",
    f"""
    SELECT release_tag, subject, unnest(list_filter(rules, lambda x: x IS NOT NULL)) AS rule FROM (
      SELECT p_type AS release_tag, '' AS subject, [CASE WHEN p_type = 'PROMO' THEN 'schema_version' END,
        'release_tag_pattern'] AS rules FROM part GROUP BY p_type
      UNION ALL SELECT DISTINCT p_type, 'T' || p_size,
        [CASE WHEN p_size % 10 = 0 THEN 'missing_base_url' END] FROM part
      UNION ALL SELECT DISTINCT p_type, 'T' || p_size || '/' || {sql_map(TEXTURED, "p_type")},
        [CASE WHEN p_size % 7 = 0 THEN 'no_bundle' END, CASE WHEN p_size % 5 = 0 THEN 'no_rowmap' END]
      FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM')
      UNION ALL SELECT DISTINCT p_type, 'T' || p_size, ['missing_sources']
      FROM part WHERE p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM'))""",
)
def check_manifest(spark, d):
    """One manifest per part type, one tier per part size, one source or none per tier."""
    p = table(spark, d, "part").select("p_type", "p_size").distinct()
    n = F.col("p_size")
    none = F.array().cast("array<string>")
    entry = F.struct(
        F.when(n % 7 == 0, none).otherwise(F.array(F.lit("b.parquet"))).alias("parquet_files"),
        F.when(n % 5 == 0, none).otherwise(F.array(F.lit("r.json"))).alias("rowmap_files"),
        F.lit(None).cast("string").alias("rowmap_file"),
    )
    source = lookup(F.col("p_type"), TEXTURED)
    sources = F.when(source.isNotNull(), F.create_map(F.coalesce(source, F.lit("-")), entry))
    tier = F.struct(
        F.concat(F.lit("T"), n.cast("string")),
        F.struct(
            F.when(n % 10 != 0, F.lit("https://example.org/")).alias("base_url"),
            sources.alias("sources"),
        ),
    )
    manifests = p.groupBy(F.col("p_type").alias("release_tag")).agg(
        F.map_from_entries(F.collect_list(tier)).alias("tiers")
    )
    version = F.when(F.col("release_tag") != "PROMO", F.lit(1)).otherwise(F.lit(2))
    return Q.check_manifest(manifests.withColumn("schema_version", version))
