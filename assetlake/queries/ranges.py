"""Rowmap and look-up queries, and round trips through bundle files."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import payload as B
from assetlake.functions.names import asset_name
from assetlake.operators import lookup as L
from assetlake.operators import quality as Q
from assetlake.operators import releases as V
from assetlake.operators import rowmap as M
from assetlake.operators.select import texture_hashes
from assetlake.plans import bake as P
from assetlake.plans import derive as D
from assetlake.queries.registry import (
    SQL,
    manifest_files,
    mat,
    query,
    requests,
    rowmap,
    table,
    tex,
)
from assetlake.session import cut, run_dir
from assetlake.sinks.bundles import write_partitioned_bundle
from assetlake.sinks.documents import write_rowmaps
from assetlake.sinks.files import inventory, write_files
from assetlake.sources import bundles as R
from assetlake.sources import metadata


@query(
    "lookup_texture",
    """
    SELECT q.request, q.source, q.tier, q.id, q.channel, r.parquet_file, r."offset", r.length,
      CASE WHEN q.tier NOT IN (SELECT tier FROM manifest_files) THEN 'tier'
        WHEN q.source NOT IN (SELECT source FROM manifest_files) THEN 'source'
        WHEN c.channels IS NULL THEN 'material' WHEN r.id IS NULL THEN 'channel' END AS error_kind,
      CASE WHEN q.tier NOT IN (SELECT tier FROM manifest_files) THEN
          (SELECT string_agg(DISTINCT tier, ',' ORDER BY tier) FROM manifest_files)
        WHEN q.source NOT IN (SELECT source FROM manifest_files) THEN
          (SELECT string_agg(DISTINCT source, ',' ORDER BY source) FROM manifest_files)
        WHEN r.id IS NULL THEN c.channels END AS available
    FROM requests q
    LEFT JOIN (SELECT source, tier, id, string_agg(channel, ',' ORDER BY channel) AS channels
      FROM rowmap GROUP BY source, tier, id) c USING (source, tier, id)
    LEFT JOIN rowmap r USING (source, tier, id, channel)""",
    "requests", "manifest_files", "rowmap",
)
def lookup_texture(spark, d):
    out = L.lookup_texture(requests(spark, d), manifest_files(spark, d), rowmap(spark, d))
    return out.withColumn("available", F.array_join("available", ","))


@query(
    "lookup_alternatives",
    """
    SELECT DISTINCT source, tier, id FROM rowmap WHERE (source, tier) IN (
      SELECT (q.source, q.tier) FROM requests q
      WHERE q.tier IN (SELECT tier FROM manifest_files) AND q.source IN (SELECT source FROM manifest_files)
        AND (q.source, q.tier, q.id) NOT IN (SELECT (source, tier, id) FROM rowmap))""",
    "requests", "manifest_files", "rowmap",
)
def lookup_alternatives(spark, d):
    ranges = rowmap(spark, d)
    return L.alternatives(L.lookup_texture(requests(spark, d), manifest_files(spark, d), ranges), ranges)


@query(
    "rowmap_entry",
    """
    SELECT DISTINCT source, tier, id, r.channel, "offset", length, parquet_file
    FROM rowmap r JOIN requests q USING (source, tier, id)""",
    "requests", "rowmap",
)
def rowmap_entry(spark, d):
    return M.rowmap_entry(requests(spark, d), rowmap(spark, d))


def twice(spark, d):
    """Rowmap rows of which many materials lie in two bundle files."""
    t = table(spark, d, "lineitem")
    return t.select(
        F.lit("s").alias("source"), F.lit("1k").alias("tier"),
        F.col("l_partkey").cast("string").alias("id"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("channel"),
        F.concat(F.lit("f"), F.col("l_suppkey").cast("string")).alias("parquet_file"),
        F.rint(F.col("l_extendedprice") * 100).cast("long").alias("offset"),
        F.rint("l_quantity").cast("long").alias("length"),
    )


TWICE_SQL = """
  SELECT 's' AS source, '1k' AS tier, CAST(l_partkey AS VARCHAR) AS id, 'c' || l_linenumber AS channel,
    'f' || l_suppkey AS parquet_file,
    CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS "offset",
    CAST(round_even(l_quantity, 0) AS BIGINT) AS length
  FROM lineitem"""


@query(
    "merge_rowmaps",
    f"""
    SELECT * FROM ({TWICE_SQL}) t WHERE parquet_file =
      (SELECT max('f' || l_suppkey) FROM lineitem l WHERE CAST(l.l_partkey AS VARCHAR) = t.id)""",
)
def merge_rowmaps(spark, d):
    return M.merge_rowmaps(twice(spark, d))


@query(
    "rowmap_stats",
    """
    SELECT parquet_file, count(DISTINCT id) AS materials, count(*) AS channels FROM rowmap
    GROUP BY parquet_file""",
    "rowmap",
)
def rowmap_stats(spark, d):
    return M.rowmap_stats(rowmap(spark, d), ["parquet_file"])


@query("list_tiers", "SELECT DISTINCT tier FROM manifest_files", "manifest_files")
def list_tiers(spark, d):
    return L.tiers(manifest_files(spark, d))


@query(
    "list_sources",
    "SELECT DISTINCT source FROM manifest_files WHERE tier = '1k'",
    "manifest_files",
)
def list_sources(spark, d):
    return L.sources(manifest_files(spark, d), "1k")


@query("list_materials", "SELECT DISTINCT source, tier, id FROM rowmap", "rowmap")
def list_materials(spark, d):
    return L.materials(rowmap(spark, d))


@query(
    "list_channels",
    """SELECT source, tier, id, string_agg(channel, ',' ORDER BY channel) AS channels FROM rowmap
       GROUP BY source, tier, id""",
    "rowmap",
)
def list_channels(spark, d):
    return L.channels(rowmap(spark, d)).withColumn("channels", F.array_join("channels", ","))


@query(
    "prefetch",
    "SELECT source, tier, id, channel FROM rowmap WHERE source = 'ambientcg' AND tier = '1k'",
    "rowmap",
)
def prefetch(spark, d):
    return P.prefetch(rowmap(spark, d), "ambientcg", "1k")


@query(
    "check_rowmap",
    """
    SELECT parquet_file, id, channel, unnest(list_filter([
        CASE WHEN channel NOT IN ('color', 'normal', 'roughness') THEN 'channel_enum' END,
        CASE WHEN len < 1 THEN 'length_range' END,
        CASE WHEN "offset" < before THEN 'overlap' END], lambda x: x IS NOT NULL)) AS rule
    FROM (SELECT *, max("offset" + len) OVER (PARTITION BY parquet_file ORDER BY "offset", id, channel
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM (SELECT parquet_file, id, CASE WHEN channel = 'ao' THEN 'gloss' ELSE channel END AS channel,
          "offset", CASE WHEN length < 500 THEN 0 WHEN length > 8000 THEN length + 1 ELSE length END AS len
        FROM rowmap))""",
    "rowmap",
)
def check_rowmap(spark, d):
    """Short payloads have lost their length, long ones are one byte too long, one channel is wrong."""
    n = F.col("length")
    bad = rowmap(spark, d).withColumns(
        {
            "length": F.when(n < 500, 0).when(n > 8000, n + 1).otherwise(n),
            "channel": F.when(F.col("channel") == "ao", "gloss").otherwise(F.col("channel")),
        }
    )
    return Q.check_rowmap(bad)


@query(
    "check_rowmap_documents",
    """
    SELECT parquet_file, subject, rule FROM (
      SELECT parquet_file, id || '/gloss' AS subject, 'channel_enum' AS rule FROM rowmap WHERE channel = 'ao'
      UNION ALL SELECT parquet_file, id || '/' || CASE WHEN channel = 'ao' THEN 'gloss' ELSE channel END,
        'length_range' FROM rowmap WHERE length < 500
      UNION ALL SELECT DISTINCT parquet_file, '', 'release_tag_pattern' FROM rowmap)""",
    "rowmap",
)
def check_rowmap_documents(spark, d):
    """Documents read back from files: short payloads have lost their length, one channel and the tag are wrong."""
    rows = rowmap(spark, d).withColumns(
        {
            "length": F.when(F.col("length") < 500, 0).otherwise(F.col("length")),
            "channel": F.when(F.col("channel") == "ao", "gloss").otherwise(F.col("channel")),
        }
    )
    path = run_dir(spark, "rowmaps")
    files = rows.select("parquet_file", "source", "tier").distinct()
    write_files(M.rowmap_documents(rows, files, "2026.4"), path)
    documents = spark.read.schema(S.ROWMAP_SCHEMA).json(path, multiLine=True)
    return Q.check_rowmap_documents(documents)


@query(
    "rowmap_documents",
    """
    SELECT replace(replace(parquet_file, 'assetlake-', ''), '.parquet', '') || '-rowmap.json' AS file,
      '{"version":1,"release_tag":"v2026.04.0","source":"' || source || '","tier":"1k","parquet_file":"' ||
      parquet_file || '","materials":{' || string_agg('"' || id || '":{' || chs || '}', ',' ORDER BY id)
      || '}}' AS content
    FROM (SELECT source, parquet_file, id, string_agg('"' || channel || '":{"offset":' || "offset" ||
        ',"length":' || length || '}', ',' ORDER BY channel) AS chs
      FROM rowmap GROUP BY ALL) GROUP BY source, parquet_file""",
    "rowmap",
)
def rowmap_documents(spark, d):
    rows = rowmap(spark, d)
    files = rows.select("parquet_file", "source", "tier").distinct()
    return M.rowmap_documents(rows, files, "v2026.04.0")


ROWMAP_TEXT = SQL["rowmap_documents"]


@query(
    "rowmap_files",
    f"SELECT file, octet_length(encode(content)) AS length, sha256(content) AS sha256 FROM ({ROWMAP_TEXT})",
    "rowmap",
)
def rowmap_files(spark, d):
    """Rowmaps written in parts of a few kilobytes and joined, against the text as one value."""
    rows = rowmap(spark, d)
    path = run_dir(spark, "rowmaps")
    write_rowmaps(rows, rows.select("parquet_file", "source", "tier").distinct(), "v2026.04.0", path, part_bytes=4096)
    return written_files(spark, path)


def written_files(spark, path):
    """(file, length, sha256) of the JSON files below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.sha2("content", 256).alias("sha256")
    )


@query(
    "rowmap_buckets",
    """SELECT q.source, q.tier, q.id, r.channel, r."offset", r.length, r.parquet_file
       FROM (SELECT DISTINCT source, tier, id FROM requests) q JOIN rowmap r USING (source, tier, id)""",
    "requests", "rowmap",
)
def rowmap_buckets(spark, d):
    """Look-ups in a rowmap stored in buckets of the keys, which is not shuffled for them."""
    path = run_dir(spark, "rowmap")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    return M.rowmap_entry(requests(spark, d), M.write_rowmap_table(rowmap(spark, d), name, 8, path))


@query(
    "read_rowmap",
    'SELECT source, tier, parquet_file, id, channel, "offset", length FROM rowmap',
    "rowmap",
)
def read_rowmap(spark, d):
    path = run_dir(spark, "rowmaps")
    write_files(rowmap_documents(spark, d), path)
    out = metadata.read_rowmap(spark, path)
    return out.select("source", "tier", "parquet_file", "id", "channel", "offset", "length")


# --- round trips: payloads written to bundles and read back ---------------------------------

LIMIT = 200_000


def png_tex(spark, d):
    """Texture rows whose payload starts with the PNG magic and ends like a PNG."""
    rows = tex(spark, d, payload=True)
    framed = F.concat(F.lit(S.PNG_MAGIC), "payload", F.lit(b"IEND\xaeB`\x82"))
    return rows.withColumn("payload", framed).withColumn("length", B.size("payload"))


FRAMED = "octet_length(encode(text)) + 12"
FRAMED_SHA = "sha256(from_hex('89504E47') || encode(text) || from_hex('49454E44AE426082'))"


def written(spark, d):
    """Bundles of all documents below a new folder: (path, textures, chunks, bundles)."""
    path = run_dir(spark, "bundles")
    rows = png_tex(spark, d)
    chunks, bundles = write_partitioned_bundle(
        rows, mat(spark, d), path, "1", "2026-04-18T00:00:00+00:00", LIMIT
    )
    return path, rows.drop("payload", "sha256"), chunks, bundles


def bundle_rowmap(spark, d):
    path, rows, chunks, bundles = written(spark, d)
    located = cut(D.rowmap_of(spark, path, rows, chunks, bundles))
    files = R.list_files(spark, path, "*.parquet").select(
        F.concat(F.regexp_extract("path", r"/bundle=([^/]+)/", 1), F.lit(".parquet"))
        .alias("parquet_file"),
        "path",
    )
    return path, located, files


@query(
    "bundle_roundtrip",
    f"""SELECT source, tier, id, channel, {FRAMED} AS length, {FRAMED_SHA} AS sha256,
          NULL::VARCHAR AS error_kind FROM tex""",
    "tex",
)
def bundle_roundtrip(spark, d):
    """Write bundles, build their rowmap from the footers, fetch every range and hash it."""
    _, located, files = bundle_rowmap(spark, d)
    got = R.fetch_ranges(located, located, files)
    return got.select(
        "source", "tier", "id", "channel", "length", B.sha256("payload").alias("sha256"),
        "error_kind",
    )


@query(
    "validate_bytes",
    f"""
    SELECT 'range_bad_magic' AS check, source || '/' || tier || '/' || id || '/' || channel AS subject
      FROM tex WHERE ({FRAMED}) % 7 = 0 AND CAST(id AS BIGINT) % 11 <> 0
    UNION ALL SELECT 'range_differs_from_index', source || '/' || tier || '/' || id || '/' || channel
      FROM tex WHERE ({FRAMED}) % 7 <> 0 AND ({FRAMED}) % 5 = 0 AND CAST(id AS BIGINT) % 11 <> 0
    UNION ALL SELECT 'index_tier_without_range', source || '/' || tier || '/' || id
      FROM tex WHERE CAST(id AS BIGINT) % 11 = 0 GROUP BY source, tier, id
    UNION ALL SELECT 'index_channel_without_range', source || '/' || tier || '/' || id || '/' || channel
      FROM tex WHERE CAST(id AS BIGINT) % 11 = 0
    UNION ALL SELECT DISTINCT 'row_groups_differ_from_rowmap', parquet_file
      FROM rowmap WHERE CAST(id AS BIGINT) % 11 = 0""",
    "tex", "rowmap",
)
def validate_bytes(spark, d):
    """Written bundles against a rowmap with shifted ranges and lost materials, and an index with
    hashes of other payloads: footers and all ranges are read."""
    path = run_dir(spark, "bundles")
    rows = png_tex(spark, d)
    chunks, bundles = write_partitioned_bundle(
        rows, mat(spark, d), path, "1", "2026-04-18T00:00:00+00:00", rotate="bytes"
    )
    placed = rows.drop("payload", "sha256")
    located = cut(D.rowmap_of(spark, path, placed, chunks, bundles))
    parts = R.footers(R.list_files(spark, path, "*.parquet"))
    name = F.concat(F.regexp_extract("path", r"/bundle=([^/]+)/", 1), F.lit(".parquet"))
    parts = cut(parts.withColumn("parquet_file", name))
    shifted = F.col("offset") + F.when(F.col("length") % 7 == 0, 1).otherwise(0)
    flawed = located.filter("cast(id AS bigint) % 11 <> 0").withColumn("offset", shifted)
    hashes = rows.withColumn("sha256", B.sha256("payload")).withColumn(
        "sha256", F.when(F.col("length") % 5 == 0, F.reverse("sha256")).otherwise(F.col("sha256"))
    )
    index = texture_hashes(hashes, ["source", "id"]).withColumn("available_tiers", F.array(F.lit("1k")))
    got = R.fetch_ranges(flawed, flawed, parts.select("parquet_file", "path").distinct())
    return V.validate_release(manifest_files(spark, d), flawed, index, parts, fetched=got)


@query(
    "read_bundle",
    f"""
    SELECT t.source, t.id, t.category, 1024 AS resolution_px, coalesce(max(m.source_url), '') AS source_url,
      coalesce(max(m.source_license), 'CC0-1.0') AS source_license,
      max(CASE WHEN channel = 'color' THEN {FRAMED} END) AS color_length
    FROM tex t LEFT JOIN mat m ON t.source = m.source AND t.id = m.id
    GROUP BY t.source, t.id, t.category""",
    "tex", "mat",
)
def read_bundle(spark, d):
    path, *_ = written(spark, d)
    out = R.read_bundle(spark, path, ["color"])
    return out.select(
        "source", "id", "category", "resolution_px", "source_url", "source_license",
        B.size("color").alias("color_length"),
    )


@query(
    "footers",
    """
    SELECT 7 * count(DISTINCT id) AS chunks, count(DISTINCT id) AS row_groups,
      7 * count(DISTINCT id) - count(*) AS null_chunks FROM tex""",
    "tex",
)
def footers(spark, d):
    path, *_ = written(spark, d)
    out = R.footers(R.list_files(spark, path, "*.parquet"))
    groups = F.count_distinct("path", "row_idx")
    return out.agg(
        F.count(F.lit(1)).alias("chunks"), groups.alias("row_groups"),
        F.count_if(F.col("null_count") == F.col("num_values")).alias("null_chunks"),
    )


@query(
    "rowmap_retrofit",
    f"""SELECT source, tier, id, channel, {FRAMED} AS length, {FRAMED_SHA} AS sha256,
          NULL::VARCHAR AS error_kind FROM tex""",
    "tex",
)
def rowmap_retrofit(spark, d):
    """Ranges of bundles whose rowmap was never written: found from the files, then fetched and hashed."""
    path, *_ = written(spark, d)
    files = R.list_files(spark, path, "*.parquet")
    # files that one task wrote for several bundles have the same name in each folder
    name = F.concat(F.regexp_extract("path", r"/bundle=([^/]+)/", 1), F.lit(".parquet")).alias("parquet_file")
    tier = F.regexp_extract("bundle", r"^assetlake-\w+?-([^-]+)-", 1)
    named = {"parquet_file": F.concat("bundle", F.lit(".parquet")), "tier": tier}
    bundle = spark.read.parquet(path).withColumns(named)
    placed = R.bundle_payloads(bundle).select("parquet_file", "source", "tier", "id", "channel", "length")
    found = M.build_rowmap(R.footers(files).withColumn("parquet_file", name), M.collector(placed))
    cells = placed.select("parquet_file", "source", "tier").distinct()
    rowmap = cut(found.join(cells, "parquet_file"))
    got = R.fetch_ranges(rowmap, rowmap, files.select(name, "path"))
    return got.select(
        "source", "tier", "id", "channel", "length", B.sha256("payload").alias("sha256"), "error_kind"
    )


@query(
    "materialize",
    """
    SELECT id || '/' || channel || '.png' AS file, octet_length(encode(text)) AS length FROM tex""",
    "tex",
)
def materialize(spark, d):
    from assetlake.sinks.documents import materialize as write

    path = run_dir(spark, "textures")
    rows = tex(spark, d, payload=True)
    write(rows.filter("channel = 'color'"), path)
    write(rows, path)
    return inventory(spark, path)


@query(
    "read_texture_tree",
    "SELECT id, channel, length, sha256 FROM tex",
    "tex",
)
def read_texture_tree(spark, d):
    from assetlake.sinks.documents import materialize as write

    path = run_dir(spark, "textures")
    write(tex(spark, d, payload=True), path)
    return R.read_texture_tree(spark, path).select(
        "id", "channel", "length", B.sha256("payload").alias("sha256")
    )


@query(
    "read_documents",
    "SELECT CAST(page_id AS VARCHAR) AS id, md5(html) AS digest FROM pages",
)
def read_documents(spark, d):
    path = run_dir(spark, "documents")
    pages = table(spark, d, "pages").select(
        F.concat(F.col("page_id").cast("string"), F.lit("/material.mtlx")).alias("file"),
        F.col("html").alias("content"),
    )
    write_files(pages.repartition(R.n_tasks(spark), "file"), path)
    return R.read_documents(spark, path).select("id", F.md5("xml").alias("digest"))


@query(
    "transcode_tier",
    f"""
    SELECT source, id, 'ktx2-1k' AS tier, channel, CASE channel WHEN 'normal' THEN 'n'
        WHEN 'color' THEN 's' ELSE 'l' END AS mode, 13 + {FRAMED} AS length FROM tex""",
    "tex",
)
def transcode_tier(spark, d):
    """The encoder here only puts the KTX2 magic and a mode letter in front of the payload."""

    def encoder(data: bytes, mode: str) -> bytes:
        return S.KTX2_MAGIC + mode[:1].encode() + data

    out = D.transcode_tier(png_tex(spark, d).drop("sha256"), "1k", encoder)
    letter = F.decode(F.substring("payload", 13, 1), "US-ASCII")
    return out.select("source", "id", "tier", "channel", letter.alias("mode"), "length")


def image_tex(spark, d):
    """Real PNG images: bytes of each text, 24 pixels wide, as rows of RGB."""
    from assetlake.functions import png
    import numpy as np

    def image(data: bytes, _mode: str) -> bytes:
        px = np.frombuffer(data + b"\0" * (-len(data) % 72), np.uint8).reshape(-1, 24, 3)
        return png.encode_rgb(px)

    rows = tex(spark, d, payload=True).drop("sha256").filter(F.col("length") > 0)
    return D.map_payloads(rows, image)


@query(
    "derive_tier",
    """
    SELECT source, id, '128' AS tier, channel,
      CASE WHEN h <= 128 THEN 24 ELSE greatest(1, CASE
        WHEN abs(24.0::DOUBLE / h - floor(w) / 128) <= abs(24.0::DOUBLE / h - ceil(w) / 128)
        THEN floor(w) ELSE ceil(w) END)::BIGINT END AS width,
      least(h, 128) AS height
    FROM (SELECT *, 128 * (24.0::DOUBLE / h) AS w FROM
      (SELECT *, (length + 71) // 72 AS h FROM tex WHERE length > 0))""",
    "tex",
)
def derive_tier(spark, d):
    out = D.derive_tier(image_tex(spark, d), "1k", "128")
    dim = B.png_dimensions("payload")
    return out.select(
        "source", "id", "tier", "channel", dim["width"].cast("long").alias("width"),
        dim["height"].cast("long").alias("height"),
    )


@query(
    "thumbnails",
    """
    SELECT source || '/' || id || '/' || channel || '_thumb.png' AS file FROM tex
    WHERE length > 0 AND channel <> 'ao'""",
    "tex",
)
def thumbnails(spark, d):
    rows = image_tex(spark, d)
    there = rows.filter("channel = 'ao'").select("source", "id", "channel")
    return D.thumbnails(rows, there, 64).select("file")


@query(
    "asset_name",
    "SELECT DISTINCT parquet_file FROM rowmap",
    "rowmap",
)
def asset_names_of_bundles(spark, d):
    return tex(spark, d).select(asset_name("source", "tier", "category").alias("parquet_file")).distinct()
