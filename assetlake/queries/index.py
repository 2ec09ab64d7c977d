"""Normalisation, index, search and catalogue-metadata queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake import specs
from assetlake.functions import names as A
from assetlake.functions import normalize as N
from assetlake.functions import payload as B
from assetlake.functions.json_schema import load_schema
from assetlake.operators import lookup as L
from assetlake.operators import quality as Q
from assetlake.operators import rowmap as M
from assetlake.operators import select as P
from assetlake.operators import usage as U
from assetlake.plans import search as D
from assetlake.queries.registry import (
    WORDS,
    manifest_files,
    mat,
    pick,
    query,
    rowmap,
    sql_category,
    sql_map,
    sql_pick,
    table,
)
from assetlake.session import run_dir
from assetlake.sinks.files import write_files
from assetlake.sources import listings, metadata
from assetlake.sources import pages as paged
from assetlake.sources.bundles import n_tasks
from assetlake.streaming.jobs import to_table

RAW_MAPS = [
    "NormalGL", "Ambient Occlusion", "nor_gl", "Base_Color", "Rough", "opacity", "arm",
    "Metallic", "HEIGHT", "Displacement", "Color",
]
LISTED = ["ambientcg", "polyhaven", "gpuopen"]


def raw_maps(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        pick(LISTED, F.col("p_partkey")).alias("source"),
        pick(RAW_MAPS, F.col("p_size")).alias("raw"),
    )


def sql_channel(source: str, raw: str) -> str:
    flat = {f"{s}:{a}": c for (s, a), c in S.channel_dictionary().items()}
    return sql_map(flat, f"({source} || ':' || replace(replace(lower({raw}), ' ', ''), '_', ''))")


RAW_SQL = f"""
  SELECT p_partkey, {sql_pick(LISTED, "p_partkey")} AS source, {sql_pick(RAW_MAPS, "p_size")} AS raw
  FROM part"""


@query(
    "normalize_category",
    f"SELECT p_partkey, {sql_category('p_name')} AS category FROM part",
)
def normalize_category(spark, d):
    raw = F.concat(F.lit(" "), F.upper("p_name"), F.lit("/"), "p_type")
    return table(spark, d, "part").select(
        "p_partkey", N.normalize_category(raw, WORDS).alias("category")
    )


@query(
    "map_category",
    f"SELECT p_partkey, p_name, {sql_category('p_name')} AS category FROM part",
)
def map_category(spark, d):
    return L.map_category(
        table(spark, d, "part"), S.keywords_df(spark, WORDS), "p_partkey", "p_name"
    )


@query(
    "normalize_channel",
    f"SELECT p_partkey, source, raw, {sql_channel('source', 'raw')} AS channel FROM ({RAW_SQL})",
)
def normalize_channel(spark, d):
    return raw_maps(spark, d).withColumn("channel", N.normalize_channel("source", "raw"))


@query(
    "map_channel",
    f"""SELECT * FROM (SELECT p_partkey, source, raw, {sql_channel("source", "raw")} AS channel
        FROM ({RAW_SQL})) WHERE channel IS NOT NULL""",
)
def map_channel(spark, d):
    return L.map_channel(raw_maps(spark, d), S.channel_map_df(spark))


# --- archive members, from line items -------------------------------------------------------


def members(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem")
    ext = F.when(F.col("l_returnflag") == "A", ".png").when(F.col("l_returnflag") == "N", ".JPG")
    name = F.concat(
        F.when(F.col("l_linestatus") == "F", "maps/").otherwise(""), F.lit("T"),
        F.col("l_partkey").cast("string"), F.lit("_1K_"),
        F.translate(pick(RAW_MAPS, F.col("l_suppkey") + F.col("l_linenumber")), " ", ""),
        ext.otherwise(".mtlx"),
    )
    escape = F.when((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0), "../").otherwise("")
    return t.select(
        F.col("l_orderkey").cast("string").alias("archive"),
        (F.rint(F.col("l_extendedprice") * 100).cast("long") * 10 + F.col("l_linenumber"))
        .alias("member_no"),
        F.concat(escape, name).alias("member"),
        F.rint(F.col("l_extendedprice") * 100).cast("long").alias("size"),
        F.rint(F.col("l_quantity") * 10000).cast("long").alias("compressed"),
    )


MEMBERS_SQL = f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS archive,
    CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) * 10 + l_linenumber AS member_no,
    CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0 THEN '../' ELSE '' END ||
      CASE WHEN l_linestatus = 'F' THEN 'maps/' ELSE '' END || 'T' || l_partkey || '_1K_' ||
      replace({sql_pick(RAW_MAPS, "l_suppkey + l_linenumber")}, ' ', '') ||
      CASE l_returnflag WHEN 'A' THEN '.png' WHEN 'N' THEN '.JPG' ELSE '.mtlx' END AS member,
    CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS size,
    CAST(round_even(l_quantity * 10000, 0) AS BIGINT) AS compressed
  FROM lineitem"""
MEMBER_CHANNEL_SQL = f"""
  SELECT *, {sql_channel("'ambientcg'", "nullif(regexp_extract(member, '(?i)_([A-Za-z]+)\\.(png|jpg)$', 1), '')")} AS channel
  FROM ({MEMBERS_SQL})"""


@query(
    "channel_from_member",
    f"SELECT archive, member_no, member, channel FROM ({MEMBER_CHANNEL_SQL})",
)
def channel_from_member(spark, d):
    raw = N.channel_from_member("member")
    return members(spark, d).select(
        "archive", "member_no", "member",
        N.normalize_channel("ambientcg", raw).alias("channel"),
    )


@query(
    "channel_from_tokens",
    f"""
    SELECT archive, member_no, member, CASE WHEN regexp_matches(b, '\\.(png|jpg|jpeg|tif|tiff|exr)$')
      THEN list_filter(list_transform(list_reverse(string_split_regex(
        regexp_replace(b, '\\.[^.]*$', ''), '[_-]')), lambda t: {sql_channel("'gpuopen'", "t")}),
        lambda c: c IS NOT NULL)[1] END AS channel
    FROM (SELECT *, lower(list_extract(string_split(member, '/'), -1)) AS b FROM ({MEMBERS_SQL}))""",
)
def channel_from_tokens(spark, d):
    return members(spark, d).select(
        "archive", "member_no", "member", N.channel_from_tokens("member").alias("channel")
    )


@query(
    "first_channel_wins",
    f"""
    SELECT archive, channel, member_no, member FROM (
      SELECT *, row_number() OVER (PARTITION BY archive, channel ORDER BY member_no) AS rn
      FROM ({MEMBER_CHANNEL_SQL}) WHERE channel IS NOT NULL) WHERE rn = 1""",
)
def first_channel_wins(spark, d):
    named = channel_from_member(spark, d).filter("channel is not null")
    return M.first_channel_wins(named, ["archive"])


SAFETY_SQL = f"""
  SELECT *, CASE WHEN escape THEN 'path_escape' WHEN largest > 9000000 THEN 'file_too_large'
      WHEN total > 30000000 THEN 'total_too_large' WHEN ratio > 25 THEN 'ratio_too_high' END
      AS violation
  FROM (SELECT archive, count(*) AS members, CAST(sum(size) AS BIGINT) AS total, max(size) AS largest,
      CAST(sum(compressed) AS BIGINT) AS compressed,
      sum(size)::DOUBLE / sum(compressed)::DOUBLE AS ratio,
      bool_or(starts_with(member, '../')) AS escape
    FROM ({MEMBERS_SQL}) GROUP BY archive)"""
LIMITS = {"max_total": 30_000_000, "max_file": 9_000_000, "max_ratio": 25.0}


@query("archive_safety", f"SELECT * EXCLUDE (escape) FROM ({SAFETY_SQL})")
def archive_safety(spark, d):
    return Q.archive_safety(members(spark, d), **LIMITS)


@query(
    "safe_members",
    f"""SELECT archive, member_no, member, size, compressed FROM ({MEMBERS_SQL})
        WHERE archive IN (SELECT archive FROM ({SAFETY_SQL}) WHERE violation IS NULL)""",
)
def safe_members(spark, d):
    return Q.safe_members(members(spark, d), **LIMITS)


# --- scalar functions ----------------------------------------------------------------------


@query(
    "first_category",
    """
    SELECT p_partkey, CASE p_size % 4 WHEN 3 THEN '' WHEN 2 THEN p_type
      ELSE split_part(p_name, ' ', 1) END AS category FROM part""",
)
def first_category(spark, d):
    words = F.split("p_name", " ")
    as_object = F.concat(
        F.lit('{"'), words[0], F.lit('": 1, "z'), words[1], F.lit('": 2}')
    )
    n = F.col("p_size") % 4
    raw = (
        F.when(n == 0, as_object)
        .when(n == 1, F.to_json(words))
        .when(n == 2, F.col("p_type"))
        .otherwise(F.when(F.col("p_size") % 8 == 3, "[]").otherwise("{}"))
    )
    return table(spark, d, "part").select("p_partkey", N.first_category(raw).alias("category"))


def downloads(n: Column, key: Column) -> Column:
    """Download list of a part: one entry per tier it is large enough for."""

    def entry(attribute: str) -> Column:
        return F.struct(
            F.lit(attribute).alias("attribute"),
            F.concat(F.lit(f"/{attribute.lower()}/"), key.cast("string")).alias("fullDownloadPath"),
        )

    return F.array_compact(
        F.array(
            F.when(n % 2 == 0, entry("1k-jpg")),
            F.when(n >= 10, entry("1k-png")),
            F.when(n >= 20, entry("2K-PNG")),
            F.when(n >= 40, entry("4K-Png")),
        )
    )


@query(
    "download_url",
    """
    SELECT p_partkey, CASE WHEN p_size >= 10 THEN '/1k-png/' || p_partkey END AS url_256,
      CASE WHEN p_size >= 20 THEN '/2k-png/' || p_partkey END AS url_2k,
      CASE WHEN p_size >= 40 THEN '/4k-png/' || p_partkey END AS url_4k,
      NULL::VARCHAR AS url_8k FROM part""",
)
def download_url(spark, d):
    rows = table(spark, d, "part").withColumn("x", downloads(F.col("p_size"), F.col("p_partkey")))
    tiers = [("256", "url_256"), ("2k", "url_2k"), ("4k", "url_4k"), ("8k", "url_8k")]
    return rows.select("p_partkey", *[N.download_url("x", t).alias(c) for t, c in tiers])


@query("has_download", "SELECT p_partkey, p_size FROM part WHERE p_size >= 40")
def has_download(spark, d):
    rows = table(spark, d, "part").withColumn(
        "downloads", downloads(F.col("p_size"), F.col("p_partkey"))
    )
    return P.has_download(rows, "4k").select("p_partkey", "p_size")


@query(
    "pick_format",
    """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '/p/' || p_partkey
      WHEN p_size % 3 = 1 THEN '/j/' || p_partkey END AS url FROM part""",
)
def pick_format(spark, d):
    key, n = F.col("p_partkey").cast("string"), F.col("p_size") % 3

    def entry(prefix: str) -> Column:
        url = F.concat(F.lit(prefix), key)
        return F.struct(url.alias("url"), F.lit(1).cast("long").alias("size"))

    no_url = F.struct(F.lit(None).cast("string").alias("url"), F.lit(1).cast("long").alias("size"))
    formats = (
        F.when(n == 0, F.create_map(F.lit("jpg"), entry("/j/"), F.lit("png"), entry("/p/")))
        .when(n == 1, F.create_map(F.lit("jpg"), entry("/j/"), F.lit("exr"), entry("/e/")))
        .otherwise(F.create_map(F.lit("png"), no_url, F.lit("jpg"), entry("/j/")))
    )
    return table(spark, d, "part").select("p_partkey", N.pick_format(formats).alias("url"))


@query(
    "clean_tags",
    """
    SELECT c_custkey, list_aggregate(list_filter(list_transform(string_split(x, ','),
        lambda t: trim(t)), lambda t: t <> ''), 'string_agg', '|') AS tags
    FROM (SELECT c_custkey, ' ' || c_name || ' ,, ' || c_mktsegment || ',' AS x FROM customer)""",
)
def clean_tags(spark, d):
    raw = F.concat(F.lit(" "), "c_name", F.lit(" ,, "), "c_mktsegment", F.lit(","))
    return table(spark, d, "customer").select(
        "c_custkey", F.array_join(N.clean_tags(raw), "|").alias("tags")
    )


@query("slug", "SELECT p_partkey, replace(lower(p_name || ' ' || p_type), ' ', '_') AS slug FROM part")
def slug(spark, d):
    name = F.concat_ws(" ", "p_name", "p_type")
    return table(spark, d, "part").select("p_partkey", N.slug(name).alias("slug"))


@query(
    "date_part10",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE
      strftime(o_orderdate, '%Y-%m-%d') END AS last_updated FROM orders""",
)
def date_part10(spark, d):
    stamp = F.when(
        F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    )
    return table(spark, d, "orders").select(
        "o_orderkey", N.date_part10(stamp).alias("last_updated")
    )


@query(
    "rgb_to_hex",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_quantity >= 5 THEN
      printf('#%02X%02X%02X', CAST(round_even(l_discount * 255.0::DOUBLE, 0) AS INTEGER),
        CAST(round_even(l_tax * 255.0::DOUBLE, 0) AS INTEGER),
        CAST(round_even(l_quantity / 40.0::DOUBLE * 255.0::DOUBLE, 0) AS INTEGER)) END AS color_hex
    FROM lineitem""",
)
def rgb_to_hex(spark, d):
    three = F.array("l_discount", "l_tax", F.col("l_quantity") / 40.0)
    rgb = F.when(F.col("l_quantity") >= 5, three).otherwise(F.array("l_discount", "l_tax"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", N.rgb_to_hex(rgb).alias("color_hex")
    )


@query(
    "hex_colors",
    """
    SELECT id, color_hex, CAST('0x' || color_hex[2:] AS BIGINT) AS color_int,
      CAST('0x' || color_hex[2:3] AS BIGINT) / 255.0::DOUBLE AS r,
      CAST('0x' || color_hex[4:5] AS BIGINT) / 255.0::DOUBLE AS g,
      CAST('0x' || color_hex[6:7] AS BIGINT) / 255.0::DOUBLE AS b,
      1.0::DOUBLE AS a
    FROM mat""",
    "mat",
)
def hex_colors(spark, d):
    rgba = N.hex_to_rgba("color_hex")
    parts = [rgba[i].alias(c) for i, c in enumerate("rgba")]
    return mat(spark, d).select(
        "id", "color_hex", N.hex_to_int("color_hex").alias("color_int"), *parts
    )


@query(
    "tier_px",
    f"""SELECT p_partkey, tier, CAST({sql_map({t: str(px) for t, px in S.TIER_PX.items()}, "tier")}
        AS INTEGER) AS px FROM (SELECT p_partkey, {sql_pick([*S.TIER_PX, "mtlx"], "p_size")} AS tier
        FROM part)""",
)
def tier_px(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", pick([*S.TIER_PX, "mtlx"], F.col("p_size")).alias("tier")
    )
    return rows.withColumn("px", N.tier_px("tier"))


@query(
    "upstream_url",
    """
    SELECT id, source, CASE source WHEN 'ambientcg' THEN 'https://ambientcg.com/a/' || id
      WHEN 'polyhaven' THEN 'https://polyhaven.com/a/' || id
      WHEN 'gpuopen' THEN 'https://matlib.gpuopen.com/main/materials/all?material=' || id
      ELSE 'https://physicallybased.info' END AS url FROM mat""",
    "mat",
)
def upstream_url(spark, d):
    return mat(spark, d).select("id", "source", N.upstream_url("source", "id").alias("url"))


def release_tags(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    tag = F.concat(
        F.when(F.col("o_orderstatus") == "P", "r").otherwise("v"),
        F.date_format("o_orderdate", "yyyy.MM"), F.lit("."),
        (F.col("o_custkey") % 12).cast("string"),
    )
    return o.select("o_orderkey", tag.alias("release_tag"))


TAGS_SQL = """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'r' ELSE 'v' END ||
    strftime(o_orderdate, '%Y.%m') || '.' || (o_custkey % 12) AS release_tag FROM orders"""
LATEST_SQL = f"""
  SELECT release_tag FROM ({TAGS_SQL}) WHERE release_tag LIKE 'v%'
  ORDER BY CAST(substr(release_tag, 2, 4) AS INT) DESC, CAST(substr(release_tag, 7, 2) AS INT) DESC,
    CAST(substr(release_tag, 10) AS INT) DESC LIMIT 1"""


@query(
    "release_tag_ok",
    f"SELECT o_orderkey, release_tag, release_tag LIKE 'v%' AS ok FROM ({TAGS_SQL})",
)
def release_tag_ok(spark, d):
    return release_tags(spark, d).withColumn("ok", N.release_tag_ok("release_tag"))


@query("latest_release", LATEST_SQL)
def latest_release(spark, d):
    return metadata.latest_release(release_tags(spark, d))


@query(
    "resolve_release",
    f"""
    SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 5 = 0 THEN '/m/' || o_custkey END,
      CASE WHEN o_custkey % 3 = 0 THEN release_tag END, (SELECT release_tag FROM ({LATEST_SQL}))) AS resolved
    FROM ({TAGS_SQL}) JOIN orders USING (o_orderkey)""",
)
def resolve_release(spark, d):
    """Orders ask for a manifest, a tag, both or neither."""
    tags, orders = release_tags(spark, d), table(spark, d, "orders").select("o_orderkey", "o_custkey")
    asked = tags.join(orders, "o_orderkey").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 3 == 0, F.col("release_tag")).alias("tag"),
        F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit("/m/"), "o_custkey")).alias("manifest"),
    )
    return metadata.resolve_releases(asked, tags).select("o_orderkey", "resolved")


@query(
    "newer_available",
    f"""SELECT release_tag AS latest, 'v1998.01.0' AS current, release_tag <> 'v1998.01.0' AS newer
        FROM ({LATEST_SQL})""",
)
def newer_available(spark, d):
    return metadata.newer_available(release_tags(spark, d), "v1998.01.0")


@query(
    "parse_size",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CASE l_linenumber
        WHEN 1 THEN CAST(trunc(l_quantity * 1024) AS BIGINT)
        WHEN 2 THEN CAST(trunc(l_quantity / 4 * 1048576) AS BIGINT)
        WHEN 3 THEN CAST(trunc(l_quantity * 1073741824) AS BIGINT)
        WHEN 4 THEN CAST(trunc(l_quantity) AS BIGINT) WHEN 5 THEN l_partkey
        WHEN 6 THEN 0 ELSE NULL END AS bytes
    FROM lineitem""",
)
def parse_size(spark, d):
    q = F.col("l_quantity")
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, F.concat(q.cast("string"), F.lit("kb")))
        .when(n == 2, F.concat((q / 4).cast("string"), F.lit(" MB ")))
        .when(n == 3, F.concat(q.cast("string"), F.lit("GB")))
        .when(n == 4, F.concat(q.cast("string"), F.lit("B")))
        .when(n == 5, F.col("l_partkey").cast("string"))
        .when(n == 6, F.lit(""))
        .otherwise(F.concat(q.cast("string"), F.lit(" parsecs")))
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", B.parse_size(text).alias("bytes")
    )


@query(
    "fmt_size",
    """
    SELECT o_orderkey, n, CASE WHEN n < 1024 THEN n || ' B'
      WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0::DOUBLE)
      WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0::DOUBLE)
      WHEN n < 1099511627776 THEN printf('%.1f GB', n / 1073741824.0::DOUBLE)
      WHEN n < 1125899906842624 THEN printf('%.1f TB', n / 1099511627776.0::DOUBLE)
      ELSE printf('%.1f PB', n / 1125899906842624.0::DOUBLE) END AS size
    FROM (SELECT o_orderkey, o_custkey * o_custkey * (o_orderkey % 1000) *
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 700 ELSE 60000 END AS n FROM orders)""",
)
def fmt_size(spark, d):
    k = F.col("o_custkey")
    factor = (
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 700)
    ).otherwise(60000)
    last = F.col("o_orderkey") % 1000
    long = F.try_multiply(F.try_multiply(F.try_multiply(k, k), last), factor.cast("long"))
    # Sizes of 8 EB and more are no longs: their text comes from the decimal product, ``n`` is null.
    wide = k.cast("decimal(19,0)") * k.cast("decimal(19,0)") * last.cast("decimal(4,0)") * factor
    rows = table(spark, d, "orders").select("o_orderkey", long.alias("n"), "o_custkey", "o_orderstatus")
    size = F.when(F.col("n").isNotNull(), B.fmt_size("n")).otherwise(B.fmt_size(wide))
    return rows.select("o_orderkey", "n", size.alias("size"))


@query(
    "score",
    """
    SELECT id, coalesce(abs(roughness - 0.3::DOUBLE), 0) +
      coalesce(abs(metalness - 0.9::DOUBLE), 0) AS score FROM mat""",
    "mat",
)
def score(spark, d):
    return mat(spark, d).select("id", B.distance(roughness=0.3, metalness=0.9).alias("score"))


# --- search --------------------------------------------------------------------------------

FLAT = ["id", "source", "category", "roughness", "metalness"]


@query(
    "search_range",
    """
    SELECT id, source, category, roughness, metalness FROM mat
    WHERE category = 'metal' AND roughness BETWEEN 0.2 AND 0.6 AND metalness BETWEEN 0.1 AND 0.9
      AND list_contains(available_tiers, '2k')""",
    "mat",
)
def search_range(spark, d):
    out = D.search(
        mat(spark, d), "metal", roughness_range=(0.2, 0.6), metalness_range=(0.1, 0.9), tier="2k"
    )
    return out.select(*FLAT)


SCORED_SQL = """
  SELECT id, source, category, roughness, metalness, s AS score FROM (
    SELECT *, coalesce(abs(roughness - 0.4::DOUBLE), 0) + coalesce(abs(metalness - 0.3::DOUBLE), 0) AS s
    FROM mat WHERE category = 'metal' AND list_contains(available_tiers, '1k')
      AND roughness BETWEEN greatest(0, 0.4::DOUBLE - 0.2::DOUBLE) AND least(1, 0.4::DOUBLE + 0.2::DOUBLE)
      AND metalness BETWEEN greatest(0, 0.3::DOUBLE - 0.2::DOUBLE) AND least(1, 0.3::DOUBLE + 0.2::DOUBLE))
  ORDER BY s, source, id LIMIT {n}"""


@query("search_scored_topk", SCORED_SQL.format(n=50), "mat")
def search_scored_topk(spark, d):
    out = D.search(mat(spark, d), "metal", roughness=0.4, metalness=0.3, score=True, limit=50)
    return out.select(*FLAT, "score")


@query("search_similar", SCORED_SQL.format(n=20), "mat")
def search_similar(spark, d):
    out = D.search_similar(mat(spark, d), "metal", roughness=0.4, metalness=0.3)
    return out.select(*FLAT, "score")


@query(
    "search_unknown_category",
    """
    SELECT id, source, category, roughness, metalness, c AS asked
    FROM mat JOIN (VALUES ('velvet'), ('wood')) v(c) ON category = c
    WHERE c IN (SELECT category FROM tex) AND source IN (SELECT source FROM manifest_files)
      AND list_contains(available_tiers, '1k')""",
    "mat", "tex", "manifest_files",
)
def search_unknown_category(spark, d):
    files = manifest_files(spark, d)
    found = [
        D.search(mat(spark, d), c, manifest_files=files).select(*FLAT, F.lit(c).alias("asked"))
        for c in ("velvet", "wood")
    ]
    return found[0].union(found[1])


@query(
    "search_without_failed",
    """
    SELECT id, source, category, roughness, metalness FROM mat
    WHERE status <> 'failed' AND list_contains(available_tiers, '4k')
      AND source IN (SELECT source FROM manifest_files)""",
    "mat", "manifest_files",
)
def search_without_failed(spark, d):
    index = P.from_sources(mat(spark, d), None, manifest_files(spark, d))
    return D.search(index, tier="4k", include_failed=False).select(*FLAT)


@query(
    "in_range",
    "SELECT id, coalesce(ior BETWEEN 1.25::DOUBLE AND 2.0::DOUBLE, false) AS inside FROM mat",
    "mat",
)
def in_range(spark, d):
    return mat(spark, d).select("id", P.in_range("ior", 1.25, 2.0).alias("inside"))


@query("by_category", "SELECT id, source FROM mat WHERE category = 'wood'", "mat")
def by_category(spark, d):
    return P.by_category(mat(spark, d), "wood", list(WORDS.values())).select("id", "source")


@query("has_tier", "SELECT id, source FROM mat WHERE list_contains(available_tiers, '8k')", "mat")
def has_tier(spark, d):
    return P.has_tier(mat(spark, d), "8k").select("id", "source")


@query(
    "from_sources",
    "SELECT id, source FROM mat WHERE source IN ('gpuopen', 'physicallybased')",
    "mat",
)
def from_sources(spark, d):
    return P.from_sources(mat(spark, d), ["gpuopen", "physicallybased"]).select("id", "source")


@query("only_ok", "SELECT id, source FROM mat WHERE status = 'ok'", "mat")
def only_ok(spark, d):
    return P.only_ok(mat(spark, d)).select("id", "source")


@query(
    "listing_window",
    "SELECT id, name FROM mat ORDER BY name, id LIMIT 100 OFFSET 40",
    "mat",
)
def listing_window(spark, d):
    return P.listing_window(mat(spark, d), ["name", "id"], 40, 100).select("id", "name")


@query("first_ids", "SELECT DISTINCT id FROM mat ORDER BY id LIMIT 25", "mat")
def first_ids(spark, d):
    return P.first_ids(mat(spark, d), 25)


@query(
    "is_scalar_only",
    "SELECT id, len(maps) = 0 AS scalar_only FROM mat",
    "mat",
)
def is_scalar_only(spark, d):
    return mat(spark, d).select("id", P.is_scalar_only().alias("scalar_only"))


@query(
    "needs_bake",
    "SELECT id, status = 'failed' AND len(maps) = 0 AS needs_bake FROM mat",
    "mat",
)
def needs_bake(spark, d):
    flag = P.needs_bake(F.col("status") == "failed", F.size("maps"))
    return mat(spark, d).select("id", flag.alias("needs_bake"))


TIER_PAIRS = list(S.TIER_PX)


@query(
    "derivable",
    f"""
    SELECT DISTINCT s.tier AS src_tier, t.tier AS dst_tier
    FROM (SELECT unnest(available_tiers) AS tier FROM mat) s,
      (VALUES {", ".join(f"('{t}', {px})" for t, px in S.TIER_PX.items())}) t(tier, px)
    WHERE t.px < CAST({sql_map({t: str(px) for t, px in S.TIER_PX.items()}, "s.tier")} AS INTEGER)""",
    "mat",
)
def derivable(spark, d):
    have = mat(spark, d).select(F.explode("available_tiers").alias("src_tier")).distinct()
    targets = F.explode(F.array(*[F.lit(t) for t in S.TIER_PX])).alias("dst_tier")
    return P.derivable(have.select("src_tier", targets))


@query(
    "index_projection",
    """
    SELECT id, source, name, category, array_to_string(tags, ',') AS tags, source_url, source_license,
      array_to_string(available_tiers, ',') AS available_tiers, array_to_string(maps, ',') AS maps,
      last_updated, color_hex, roughness, metalness, ior, nullif(status, 'ok') AS status
    FROM mat""",
    "mat",
)
def index_projection(spark, d):
    out = P.index_projection(mat(spark, d))
    arrays = {c: F.array_join(c, ",") for c in ("tags", "available_tiers", "maps")}
    return out.withColumns(arrays).drop("source_mtlx_url", "texture_hashes")


# --- aggregates over the index -------------------------------------------------------------


@query("count_by", "SELECT source, category, count(*) AS count FROM mat GROUP BY ALL", "mat")
def count_by(spark, d):
    return U.count_by(mat(spark, d))


SUMMARY_SQL = """
  SELECT source, count(*) FILTER (WHERE status = 'ok') AS ok,
    count(*) FILTER (WHERE status <> 'ok') AS failed, count(*) AS total FROM mat GROUP BY source"""


@query("status_summary", SUMMARY_SQL, "mat")
def status_summary(spark, d):
    return Q.status_summary(mat(spark, d))


@query(
    "success_gate",
    f"""SELECT *, ok / total::DOUBLE AS share, ok / total::DOUBLE >= 0.92 AS passed
        FROM ({SUMMARY_SQL})""",
    "mat",
)
def success_gate(spark, d):
    return Q.success_gate(mat(spark, d), 0.92)


@query(
    "tier_union",
    """
    SELECT source, string_agg(tier, ',' ORDER BY tier) AS tiers FROM
      (SELECT DISTINCT source, unnest(available_tiers) AS tier FROM mat) GROUP BY source""",
    "mat",
)
def tier_union(spark, d):
    return U.tier_union(mat(spark, d)).withColumn("tiers", F.array_join("tiers", ","))


@query(
    "catalog_totals",
    """
    SELECT count(*) AS materials, count(DISTINCT source) AS sources,
      (SELECT count(DISTINCT tier) FROM manifest_files) AS tiers FROM mat""",
    "mat", "manifest_files",
)
def catalog_totals(spark, d):
    return U.catalog_totals(mat(spark, d), manifest_files(spark, d))


def releases_of_index(spark: SparkSession, d: str) -> DataFrame:
    """Two releases of the index: the second renames, drops tiers and adds a map."""
    new = mat(spark, d)
    old = new.withColumns(
        {
            "name": F.concat(F.lit("old "), "name"),
            "available_tiers": F.filter("available_tiers", lambda t: t != "2k"),
            "maps": F.array(F.lit("ao")),
        }
    )
    newer = new.withColumn("available_tiers", F.filter("available_tiers", lambda t: t != "1k"))
    return old.withColumn("release_tag", F.lit("v2026.04.0")).unionByName(
        newer.filter("status = 'ok'").withColumn("release_tag", F.lit("v2026.05.0"))
    )


@query(
    "merge_index",
    """
    SELECT id, source, CASE WHEN status = 'ok' THEN name ELSE 'old ' || name END AS name,
      array_to_string(list_sort(CASE WHEN status = 'ok' THEN available_tiers
        ELSE list_filter(available_tiers, lambda t: t <> '2k') END), ',') AS available_tiers,
      array_to_string(list_sort(CASE WHEN status = 'ok' THEN list_concat(maps, ['ao'])
        ELSE ['ao'] END), ',') AS maps
    FROM mat""",
    "mat",
)
def merge_index(spark, d):
    out = U.merge_index(releases_of_index(spark, d))
    return out.select(
        "id", "source", "name",
        F.array_join("available_tiers", ",").alias("available_tiers"),
        F.array_join("maps", ",").alias("maps"),
    )


@query(
    "latest_per_key",
    """
    SELECT id, source, CASE WHEN status = 'ok' THEN name ELSE 'old ' || name END AS name,
      CASE WHEN status = 'ok' THEN 'v2026.05.0' ELSE 'v2026.04.0' END AS release_tag FROM mat""",
    "mat",
)
def latest_per_key(spark, d):
    rows = releases_of_index(spark, d).select("id", "source", "name", "release_tag")
    return M.latest_per_key(rows, ["id", "source"], "release_tag")


@query(
    "with_fallback",
    """
    SELECT source, id, name FROM mat WHERE source IN ('ambientcg', 'gpuopen')
    UNION ALL SELECT source, id, 'old ' || name FROM mat WHERE source NOT IN ('ambientcg', 'gpuopen')""",
    "mat",
)
def with_fallback(spark, d):
    rows = mat(spark, d).select("source", "id", "name")
    primary = rows.filter(F.col("source").isin("ambientcg", "gpuopen"))
    older = rows.withColumn("name", F.concat(F.lit("old "), "name"))
    return metadata.with_fallback(primary, older)


@query(
    "union_sources",
    "SELECT id, source, category FROM mat ORDER BY source, id",
    "mat",
)
def union_sources(spark, d):
    index = mat(spark, d).select("id", "source", "category")
    parts = [index.filter(F.col("source") == s) for s in S.SOURCES]
    return L.union_sources(*parts).orderBy("source", "id")


@query(
    "all_sources",
    "SELECT DISTINCT source FROM manifest_files UNION SELECT 'physicallybased'",
    "manifest_files",
)
def all_sources(spark, d):
    return L.all_sources(manifest_files(spark, d), "physicallybased")


# --- joins with the index ------------------------------------------------------------------


@query(
    "enrich",
    """
    SELECT r.source, r.id, count(*) AS textures, max(coalesce(m.name, r.id)) AS name,
      max(coalesce(m.category, 'other')) AS category, max(coalesce(m.source_url, '')) AS source_url,
      max(coalesce(m.source_license, 'CC0-1.0')) AS source_license
    FROM rowmap r LEFT JOIN mat m ON r.source = m.source AND r.id = m.id GROUP BY r.source, r.id""",
    "rowmap", "mat",
)
def enrich(spark, d):
    per_id = rowmap(spark, d).groupBy("source", "id").agg(F.count(F.lit(1)).alias("textures"))
    return L.enrich(per_id, mat(spark, d))


@query(
    "fill_scalars",
    """
    SELECT id, source, array_to_string(maps, ',') AS maps,
      CASE WHEN NOT list_contains(maps, 'roughness') THEN roughness END AS roughness,
      CASE WHEN NOT list_contains(maps, 'metalness') THEN metalness END AS metalness,
      CASE WHEN NOT list_contains(maps, 'color') THEN color_hex END AS color_hex, ior
    FROM mat""",
    "mat",
)
def fill_scalars(spark, d):
    index = mat(spark, d)
    out = L.fill_scalars(index.select("id", "source", "maps"), index)
    return out.withColumn("maps", F.array_join("maps", ","))


@query(
    "with_thumbnail",
    """
    SELECT m.id, m.source, EXISTS (SELECT 1 FROM tex t WHERE t.source = m.source AND t.id = m.id
      AND t.channel = 'color') AS has_color FROM mat m""",
    "mat", "tex",
)
def with_thumbnail(spark, d):
    return L.with_thumbnail(mat(spark, d).select("id", "source"), rowmap(spark, d))


@query(
    "original_document",
    """
    SELECT m.id, m.source, md5(p.html) AS digest FROM mat m
    LEFT JOIN (SELECT *, CASE WHEN page_id % 3 = 0 THEN 'gpuopen' ELSE 'ambientcg' END AS source
      FROM pages) p ON m.source = p.source AND m.id = CAST(p.page_id AS VARCHAR)""",
    "mat",
)
def original_document(spark, d):
    docs = table(spark, d, "pages").select(
        F.when(F.col("page_id") % 3 == 0, "gpuopen").otherwise("ambientcg").alias("source"),
        F.col("page_id").cast("string").alias("id"),
        F.col("html").alias("xml"),
    )
    out = L.original_document(mat(spark, d).select("id", "source"), docs)
    return out.select("id", "source", F.md5("original_xml").alias("digest"))


FAMILIES = {"anvil": "iron", "bolt": "steel", "gear": "steel", "rod": "aluminum", "plate": "steel"}
FINISHES = ["hot", "cold", "old", "new"]


@query(
    "physical_link",
    f"""
    SELECT id, source, list_filter(list_transform(tags, lambda w: {sql_map(FAMILIES, "w")}),
        lambda x: x IS NOT NULL)[1] AS physical_family,
      list_filter(tags, lambda w: w IN ('hot', 'cold', 'old', 'new'))[1] AS finish
    FROM mat""",
    "mat",
)
def physical_link(spark, d):
    families = spark.createDataFrame(list(FAMILIES.items()), "word string, physical_family string")
    return U.physical_link(mat(spark, d), families, FINISHES)


# --- rule checks ---------------------------------------------------------------------------


def flawed_index(spark: SparkSession, d: str) -> DataFrame:
    """Index with breaches of the schema in it."""
    index = mat(spark, d)
    return index.withColumns(
        {
            "roughness": F.col("roughness") * F.lit(1.1),
            "category": F.when(F.col("category") == "glass", "crystal").otherwise(F.col("category")),
            "maps": F.when(
                F.size("maps") == 1, F.concat("maps", "maps")
            ).otherwise(F.col("maps")),
            "source_mtlx_url": F.lit(None).cast("string"),
            "texture_hashes": F.when(
                F.col("metalness") > 0.9,
                F.create_map(
                    F.lit("gloss"),
                    F.struct(F.lit("zz").alias("sha256"), F.lit(0).cast("long").alias("size")),
                ),
            ),
            "name": F.when(F.col("id").endswith("77"), "").otherwise(F.col("name")),
        }
    )


@query(
    "check_index",
    """
    SELECT source, id, rule, CASE WHEN rule = 'last_updated_date' THEN 'warning' ELSE 'error' END
      AS severity
    FROM (SELECT source, id, unnest(list_filter([
        CASE WHEN roughness * 1.1::DOUBLE > 1 THEN 'roughness_range' END,
        CASE WHEN category = 'glass' THEN 'category_enum' END,
        CASE WHEN len(maps) = 1 THEN 'maps_unique' END,
        CASE WHEN metalness > 0.9 THEN 'hash_channel' END,
        CASE WHEN metalness > 0.9 THEN 'hash_shape' END,
        CASE WHEN id LIKE '%77' THEN 'empty_name' END,
        CASE WHEN last_updated = '' THEN 'last_updated_date' END], lambda x: x IS NOT NULL)) AS rule
      FROM mat)""",
    "mat",
)
def check_index(spark, d):
    """The rules are read from the schema document that was written."""
    root = run_dir(spark, "schemas")
    specs.write_schemas(root)
    return Q.check_index(flawed_index(spark, d), schema=load_schema(f"{root}/index-schema.json"))


# --- landed JSON files, written from the tables and read back ------------------------------


def listing_path(spark: SparkSession, d: str, kind: str) -> str:
    """Listing files of 100 entries each, as an upstream service would page them."""
    return landed(run_dir(spark, "listing"), listing_pages(table(spark, d, "part"), kind))


def listing_pages(p: DataFrame, kind: str, page: Column | None = None) -> DataFrame:
    """(page, content) of a listing of parts."""
    page = (F.floor(F.col("p_partkey") / S.LISTING_PAGE_SIZE) if page is None else page).alias("page")
    if kind == "foundAssets":
        item = F.struct(
            F.col("p_partkey").cast("string").alias("assetId"),
            F.col("p_name").alias("displayName"),
            F.concat_ws("/", "p_name", "p_type").alias("displayCategory"),
            F.split("p_name", " ").alias("tags"),
            F.lit("2026-04-18T10:00:00").alias("releaseDate"),
            F.struct(
                F.struct(
                    F.struct(
                        F.struct(
                            downloads(F.col("p_size"), F.col("p_partkey")).alias("downloads")
                        ).alias("zip")
                    ).alias("downloadFiletypeCategories")
                ).alias("default")
            ).alias("downloadFolders"),
        )
    else:
        tags = F.when(F.col("p_size") % 2 == 0, F.to_json(F.split("p_name", " ")))
        item = F.struct(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("label"),
            F.col("p_type").alias("category"),
            tags.otherwise(F.regexp_replace("p_name", " ", " , ")).alias("tags"),
            F.when(F.col("p_size") >= 10, F.lit("/f.zip")).alias("file_url"),
            F.lit("2026-04-18").alias("updated_date"),
        )
    pages = p.select(page, item.alias("i")).groupBy("page").agg(F.collect_list("i").alias(kind))
    return pages.select("page", F.to_json(F.struct(kind)).alias("content"))


def landed(path: str, pages: DataFrame, name: str = "page") -> str:
    """Write ``content`` of every row as a file of its own, as a download would leave it."""
    files = pages.select(F.concat(F.col(name).cast("string"), F.lit(".json")).alias("file"), "content")
    write_files(files.repartition(n_tasks(files.sparkSession), "file"), path)
    return path


@query(
    "read_listing_pages",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, 'ambientcg' AS source, p_name AS name,
      replace(p_name, ' ', ',') AS tags, 'https://ambientcg.com/a/' || p_partkey AS source_url,
      '2026-04-18' AS last_updated FROM part WHERE p_size >= 20""",
)
def read_listing_pages(spark, d):
    assets = listings.read_listing_pages(spark, listing_path(spark, d, "foundAssets"))
    out = listings.paged_asset_records(assets, "2k")
    return out.select(
        "id", "source", "name", F.array_join("tags", ",").alias("tags"), "source_url", "last_updated"
    )


ASSET_ROWS_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, replace(p_name, ' ', ',') AS tags,
      'https://ambientcg.com/a/' || p_partkey AS source_url FROM part WHERE p_size >= 20"""
PAGE_ITEMS = 70


def numbered_pages(spark, d) -> DataFrame:
    """Pages of 70 items from 0 on, and behind the short one a page that an older listing left."""
    p = table(spark, d, "part")
    pages = listing_pages(p, "foundAssets", F.floor(F.col("p_partkey") / PAGE_ITEMS))
    behind = p.agg(F.max(F.floor(F.col("p_partkey") / PAGE_ITEMS)) + 1).first()[0]
    return pages.unionByName(listing_pages(p.filter("p_partkey <= 9"), "foundAssets", F.lit(behind)))


def asset_rows(items: DataFrame) -> DataFrame:
    out = listings.paged_asset_records(items, "2k")
    return out.select("id", "name", F.array_join("tags", ",").alias("tags"), "source_url")


@query("listing_source", ASSET_ROWS_SQL)
def listing_source(spark, d):
    """Pages as partitions of a data source; the short page ends the listing."""
    path = landed(run_dir(spark, "listing"), numbered_pages(spark, d))
    return asset_rows(paged.read_pages(spark, path, page_size=PAGE_ITEMS))


@query("listing_source_stream", ASSET_ROWS_SQL)
def listing_source_stream(spark, d):
    """Pages land in two rounds and out of order; each is taken once all before it are there."""
    path, out, mark = (run_dir(spark, n) for n in ("listing", "listed", "mark"))
    pages = numbered_pages(spark, d)
    for part in (F.col("page") != 1, F.col("page") == 1):
        landed(path, pages.filter(part))
        stream = asset_rows(paged.stream_pages(spark, path, page_size=PAGE_ITEMS))
        to_table(stream, out, mark).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(
    "read_listing_packages",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, replace(p_name, ' ', ',') AS tags,
      CASE WHEN p_size >= 10 THEN 'TBV' ELSE 'CC0-1.0' END AS source_license,
      CASE WHEN p_size >= 10 THEN 'ok' ELSE 'failed' END AS status FROM part""",
)
def read_listing_packages(spark, d):
    packages = listings.read_listing_pages(spark, listing_path(spark, d, "results"), "results")
    out = listings.package_records(packages)
    return out.select("id", "name", F.array_join("tags", ",").alias("tags"), "source_license", "status")


@query(
    "last_pages",
    """
    SELECT count(*) AS pages, count(*) FILTER (WHERE n < 100) AS last_pages,
      CAST(sum(n) AS BIGINT) AS items
    FROM (SELECT p_partkey // 100 AS page, count(*) AS n FROM part GROUP BY 1)""",
)
def last_pages(spark, d):
    pages = spark.read.json(
        listing_path(spark, d, "results"), schema=S.PAGED_PACKAGES_SCHEMA, multiLine=True
    )
    flagged = listings.last_pages(pages, "results")
    return flagged.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if("is_last").alias("last_pages"),
        F.sum("n_items").alias("items"),
    )


@query(
    "read_listing_map",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, replace(p_name, ' ', ',') AS tags,
      'https://polyhaven.com/a/' || p_partkey AS source_url FROM part""",
)
def read_listing_map(spark, d):
    p = table(spark, d, "part")
    page = F.floor(F.col("p_partkey") / S.LISTING_PAGE_SIZE).alias("page")
    entry = F.struct(
        F.col("p_partkey").cast("string"),
        F.struct(
            F.col("p_name").alias("name"),
            F.split("p_name", " ").alias("tags"),
            F.array("p_type").alias("categories"),
        ),
    )
    docs = p.select(page, entry.alias("e")).groupBy("page").agg(
        F.to_json(F.map_from_entries(F.collect_list("e"))).alias("content")
    )
    path = landed(run_dir(spark, "slugs"), docs)
    out = listings.slug_records(listings.read_listing_map(spark, path), "1k")
    return out.select("id", "name", F.array_join("tags", ",").alias("tags"), "source_url")


@query(
    "read_scalar_materials",
    """
    SELECT replace(lower(p_name), ' ', '_') || '_' || p_partkey AS id,
      p_name || ' ' || p_partkey AS name, p_size / 50.0::DOUBLE AS roughness,
      printf('#%02X%02X%02X', CAST(round_even(p_size / 50.0::DOUBLE * 255, 0) AS INTEGER), 255, 0)
        AS color_hex
    FROM part""",
)
def read_scalar_materials(spark, d):
    p = table(spark, d, "part")
    rows = [
        F.concat_ws(" ", "p_name", "p_partkey").alias("name"),
        F.array(F.lit("Metal"), "p_type").alias("category"),
        F.array(F.col("p_size") / 50.0, F.lit(1.0), F.lit(0.0)).alias("color"),
        (F.col("p_size") / 50.0).alias("roughness"),
    ]
    page = F.floor(F.col("p_partkey") / S.LISTING_PAGE_SIZE).alias("page")
    docs = p.select(page, F.struct(*rows).alias("m")).groupBy("page").agg(
        F.to_json(F.collect_list("m")).alias("content")
    )
    path = landed(run_dir(spark, "scalars"), docs)
    out = listings.scalar_records(listings.read_scalar_materials(spark, path))
    return out.select("id", "name", "roughness", "color_hex")


@query(
    "read_asset_files",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS slug, channel, '/' || p_partkey || '/' || map ||
      CASE WHEN p_size % 2 = 0 THEN '.png' ELSE '.jpg' END AS url
    FROM part, (VALUES ('color', 'Diffuse'), ('normal', 'nor_gl'), ('roughness', 'Rough'))
      m(channel, map)
    WHERE channel <> 'roughness' OR p_size >= 25""",
)
def read_asset_files(spark, d):
    p = table(spark, d, "part")

    def tier(map_name: str) -> Column:
        base = F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(f"/{map_name}"))
        jpg = F.struct(F.concat(base, F.lit(".jpg")).alias("url"))
        png = F.struct(F.concat(base, F.lit(".png")).alias("url"))
        formats = F.when(
            F.col("p_size") % 2 == 0, F.create_map(F.lit("jpg"), jpg, F.lit("png"), png)
        ).otherwise(F.create_map(F.lit("jpg"), jpg))
        return F.create_map(F.lit("1k"), formats)

    tree = F.struct(
        tier("Diffuse").alias("Diffuse"),
        tier("nor_gl").alias("nor_gl"),
        tier("nor_dx").alias("nor_dx"),
        F.when(F.col("p_size") >= 25, tier("Rough")).alias("Rough"),
        tier("arm").alias("arm"),
        F.lit("text").alias("blend"),
    )
    path = landed(run_dir(spark, "trees"), p.select("p_partkey", F.to_json(tree).alias("content")), "p_partkey")
    return listings.map_urls(listings.read_asset_files(spark, path), "slug", "512")


@query(
    "read_index",
    """
    SELECT id, source, name, category, roughness, metalness, ior, color_hex,
      array_to_string(tags, ',') AS tags FROM mat WHERE status = 'ok'""",
    "mat",
)
def read_index(spark, d):
    from assetlake.sinks.documents import write_index

    path = run_dir(spark, "index")
    write_index(P.index_projection(mat(spark, d)), path)
    out = metadata.read_index(spark, path, multi_line=False).filter("status is null")
    return out.select(
        "id", "source", "name", "category", "roughness", "metalness", "ior", "color_hex",
        F.array_join("tags", ",").alias("tags"),
    )


@query(
    "document_ids",
    """
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'p' || page_id ELSE 'file' || page_id END AS id
    FROM pages""",
)
def document_ids(spark, d):
    key = F.col("page_id").cast("string")
    path = F.when(
        F.col("page_id") % 2 == 0, F.concat(F.lit("s3://b/x/p"), key, F.lit("/material.mtlx"))
    ).otherwise(F.concat(F.lit("/x/y/file"), key, F.lit(".mtlx")))
    return table(spark, d, "pages").select(
        "page_id", A.material_id_of_document(path).alias("id")
    )


