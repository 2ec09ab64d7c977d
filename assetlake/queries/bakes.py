"""Archives and whole bakes: files are made from the tables, then processed."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import payload as B
from assetlake.functions.normalize import upstream_url
from assetlake.operators import select as P
from assetlake.operators import usage as U
from assetlake.plans import bake as D
from assetlake.plans import catalog as G
from assetlake.plans import derive as V
from assetlake.queries.index import FAMILIES, FINISHES
from assetlake.queries.ranges import FRAMED, FRAMED_SHA
from assetlake.queries.registry import (
    CATEGORY_OF_NO,
    manifest_files,
    mat,
    pick,
    query,
    rowmap,
    sql_map,
    sql_pick,
    table,
)
from assetlake.session import run_dir
from assetlake.sinks.documents import index_json, write_index_table
from assetlake.sinks.files import apply_renames, rename_plan, write_files
from assetlake.sources import bundles as R
from assetlake.sources import metadata

ARCHIVE = pa.schema([("file", pa.string()), ("payload", pa.binary())])
MEMBER_OF_NO = ["Color.png", "NormalGL.png", "Roughness.png", "AmbientOcclusion.png"]


def archive_path(spark, d) -> str:
    """One ZIP per four documents: their texts framed as PNG, French ones as they are, and a note."""
    docs = table(spark, d, "documents")
    text = F.encode("text", "UTF-8")
    framed = F.concat(F.lit(S.PNG_MAGIC), text, F.lit(b"IEND\xaeB`\x82"))
    rows = docs.select(
        F.floor(F.col("doc_id") / 4).cast("string").alias("id"),
        F.col("doc_id").alias("no"),
        F.concat(F.lit("maps/T_1K_"), pick(MEMBER_OF_NO, F.col("doc_id"))).alias("member"),
        F.when(F.col("lang") == "fr", text).otherwise(framed).alias("payload"),
    )

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        members = (row for batch in batches for row in batch.to_pylist())
        for id_, group in groupby(members, lambda row: row["id"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zf:
                for row in group:
                    zf.writestr(row["member"], row["payload"])
                    zf.writestr(row["member"].replace("maps/", "copy/"), b"second of its channel")
                zf.writestr("readme.txt", "note")
            yield id_ + ".zip", buf.getvalue()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return R.record_batches(archives(batches), ARCHIVE)

    # as many tasks as asked for, however small the rows: a group is worth far more work than its bytes
    together = rows.repartition(R.n_tasks(spark), "id").sortWithinPartitions("id", "no")
    files = together.mapInArrow(pack, "file string, payload binary")
    path = run_dir(spark, "archives")
    write_files(files.withColumnRenamed("payload", "content"), path)
    return path


@query(
    "read_archives",
    f"""
    SELECT CAST(doc_id // 4 AS VARCHAR) AS id, 'maps/T_1K_' || {sql_pick(MEMBER_OF_NO, "doc_id")} AS member,
      octet_length(encode(text)) + CASE WHEN lang = 'fr' THEN 0 ELSE 12 END AS size FROM documents
    UNION ALL
    SELECT CAST(doc_id // 4 AS VARCHAR), 'copy/T_1K_' || {sql_pick(MEMBER_OF_NO, "doc_id")}, 21 FROM documents
    UNION ALL SELECT DISTINCT CAST(doc_id // 4 AS VARCHAR), 'readme.txt', 4 FROM documents""",
)
def read_archives(spark, d):
    out = R.read_archives(spark, archive_path(spark, d))
    return out.select(F.regexp_extract("archive", r"([^/]+)\.zip$", 1).alias("id"), "member", "size")


@query(
    "archive_textures",
    f"""
    SELECT id, channel, CASE WHEN text IS NULL THEN NULL ELSE sha256(
      CASE WHEN lang = 'fr' THEN encode(text) ELSE from_hex('89504E47') || encode(text) ||
        from_hex('49454E44AE426082') END) END AS sha256
    FROM (SELECT CAST(doc_id // 4 AS VARCHAR) AS id,
      {sql_pick(["color", "normal", "roughness", "ao"], "doc_id")} AS channel, text, lang FROM documents)""",
)
def archive_textures(spark, d):
    out = D.archive_textures(spark, archive_path(spark, d), "ambientcg")
    return out.select("id", "channel", B.sha256("payload").alias("sha256"))


def records(spark, d):
    """Records of all materials of the archives, and of as many that have no archive."""
    docs = table(spark, d, "documents")
    m = F.floor(F.col("doc_id") / 4)
    have = docs.select(m.alias("m")).distinct()
    both = have.select(F.explode(F.array(F.col("m").cast("string"), F.concat(F.lit("x"), F.col("m")))).alias("id"), "m")
    return both.select(
        "id", F.lit("ambientcg").alias("source"), F.col("id").alias("name"),
        pick(CATEGORY_OF_NO, F.col("m")).alias("category"),
        F.array().cast("array<string>").alias("tags"),
        upstream_url(F.lit("ambientcg"), "id").alias("source_url"),
        F.lit("CC0-1.0").alias("source_license"),
        F.array().cast("array<string>").alias("available_tiers"),
        F.array().cast("array<string>").alias("maps"),
        F.lit("").alias("last_updated"), F.lit("ok").alias("status"),
    )


def baked(spark, d) -> tuple[str, D.Release]:
    path = run_dir(spark, "release")
    rows = records(spark, d)
    textures = D.archive_textures(spark, archive_path(spark, d), "ambientcg", rows)
    release = D.bake(
        rows, textures, "1k", path, "v2026.04.0", "https://example.org/r/",
        "2026-04-18T00:00:00+00:00", max_bytes=100_000,
    )
    return path, release


@query(
    "bake",
    """
    SELECT 'ambientcg' AS source, CAST(doc_id // 4 AS VARCHAR) AS id, channel,
      octet_length(encode(text)) + 12 AS length,
      sha256(from_hex('89504E47') || encode(text) || from_hex('49454E44AE426082')) AS sha256
    FROM (SELECT *, list_extract(['color', 'normal', 'roughness', 'ao'], CAST(doc_id % 4 AS INTEGER) + 1)
      AS channel FROM documents) WHERE lang <> 'fr'""",
)
def bake(spark, d):
    """Archives to a published release; then every range of its rowmap is read back."""
    path, release = baked(spark, d)
    apply_renames(rename_plan(spark, f"{path}/bundles"))
    files = R.list_files(spark, f"{path}/bundles", "*.parquet").select(
        F.substring_index("path", "/", -1).alias("parquet_file"), "path"
    )
    got = R.fetch_ranges(release.rowmap, release.rowmap, files).filter("error_kind is null")
    return got.select("source", "id", "channel", "length", B.sha256("payload").alias("sha256"))


@query(
    "bake_index",
    """
    SELECT id, status, CASE status WHEN 'failed' THEN '' ELSE '1k' END AS tiers, coalesce(maps, '') AS maps
    FROM (SELECT id, CASE WHEN maps IS NULL THEN 'failed' END AS status, maps FROM (
      SELECT CAST(doc_id // 4 AS VARCHAR) AS id, string_agg(channel, ',' ORDER BY channel)
        FILTER (WHERE lang <> 'fr') AS maps
      FROM (SELECT *, list_extract(['color', 'normal', 'roughness', 'ao'], CAST(doc_id % 4 AS INTEGER) + 1)
        AS channel FROM documents) GROUP BY 1
      UNION ALL SELECT DISTINCT 'x' || CAST(doc_id // 4 AS VARCHAR), NULL FROM documents))""",
)
def bake_index(spark, d):
    """The index a bake leaves behind: materials without a valid texture are failed."""
    path, _ = baked(spark, d)
    out = metadata.read_index(spark, f"{path}/index", multi_line=False)
    return out.select(
        "id", "status", F.array_join("available_tiers", ",").alias("tiers"),
        F.array_join("maps", ",").alias("maps"),
    )


@query(
    "bake_manifest",
    f"""
    WITH RECURSIVE sizes AS (
      SELECT {sql_pick(CATEGORY_OF_NO, "(doc_id // 4)")} AS category, CAST(doc_id // 4 AS VARCHAR) AS id,
        CAST(sum(octet_length(encode(text)) + 12) AS BIGINT) AS length
      FROM documents WHERE lang <> 'fr' GROUP BY 1, 2),
    pos AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS rn FROM sizes),
    walk AS (
      SELECT category, rn, 1 AS chunk, length AS used FROM pos WHERE rn = 1
      UNION ALL
      SELECT p.category, p.rn, w.chunk + CASE WHEN w.used >= 100000 THEN 1 ELSE 0 END,
        CASE WHEN w.used >= 100000 THEN 0 ELSE w.used END + p.length
      FROM walk w JOIN pos p ON p.category = w.category AND p.rn = w.rn + 1)
    SELECT unnest(['bundle', 'rowmap']) AS kind, category, chunk FROM (
      SELECT category, chunk FROM walk GROUP BY category, chunk)""",
)
def bake_manifest(spark, d):
    """Category and chunk of every file that the manifest of a bake names; each of them was written."""
    path, release = baked(spark, d)
    files = metadata.read_manifest_files(spark, f"{path}/release-manifest.json")
    parsed = files.join(release.files.select("file_name", "category", "chunk"), "file_name")
    return parsed.select("kind", "category", F.coalesce("chunk", F.lit(1)).alias("chunk"))


@query(
    "publish_tier",
    f"""
    SELECT source, id, tier, channel, length, sha256 FROM (
      SELECT source, id, 'ktx2-1k' AS tier, channel, {FRAMED} + 12 AS length,
        sha256(from_hex('AB4B5458203230BB0D0A1A0A') || from_hex('89504E47') || encode(text) ||
          from_hex('49454E44AE426082')) AS sha256 FROM tex)""",
    "tex",
)
def publish_tier(spark, d):
    """Re-encoded tier written as bundles and read back through its rowmap."""
    from assetlake.queries.ranges import png_tex

    rows = png_tex(spark, d).drop("sha256")
    scratch, path = run_dir(spark, "ktx2"), run_dir(spark, "tier")
    V.transcode_tier(rows, "1k", lambda data, _: S.KTX2_MAGIC + data).write.parquet(scratch)
    located, _ = V.publish_tier(
        spark.read.parquet(scratch), mat(spark, d), path, "1", "2026-04-18T00:00:00+00:00", 300_000
    )
    apply_renames(rename_plan(spark, path))
    files = R.list_files(spark, path, "*.parquet").select(
        F.substring_index("path", "/", -1).alias("parquet_file"), "path"
    )
    got = R.fetch_ranges(located, located, files, magics=(S.KTX2_MAGIC,))
    return got.select("source", "id", "tier", "channel", "length", B.sha256("payload").alias("sha256"))


@query(
    "fetch_all",
    f"""SELECT channel, {FRAMED} AS length, {FRAMED_SHA} AS sha256, source, id FROM tex
        WHERE source = 'polyhaven'""",
    "tex",
)
def fetch_all(spark, d):
    """Prefetch of one source: all channels of all its materials."""
    from assetlake.queries.ranges import bundle_rowmap

    _, located, files = bundle_rowmap(spark, d)
    wanted = D.prefetch(located, "polyhaven", "1k")
    got = R.fetch_ranges(wanted, located, files)
    return got.select("channel", "length", B.sha256("payload").alias("sha256"), "source", "id")


@query(
    "index_json",
    """
    SELECT source, id, md5('{"id":"' || id || '","source":"' || source || '","name":"' || name ||
      '","category":"' || category || '","tags":["' || array_to_string(tags, '","') || '"],"source_url":"' ||
      source_url || '","source_license":"' || source_license || '","available_tiers":[' ||
      CASE WHEN len(available_tiers) = 0 THEN '' ELSE '"' || array_to_string(available_tiers, '","') || '"' END
      || '],"maps":[' || CASE WHEN len(maps) = 0 THEN '' ELSE '"' || array_to_string(maps, '","') || '"' END
      || '],"last_updated":"' || last_updated || '","color_hex":"' || color_hex || '"' ||
      coalesce(',"roughness":' || CAST(roughness AS VARCHAR), '') || ',"metalness":' ||
      CAST(metalness AS VARCHAR) || coalesce(',"ior":' || CAST(ior AS VARCHAR), '') ||
      CASE WHEN status = 'failed' THEN ',"status":"failed"' ELSE '' END || '}') AS digest FROM mat""",
    "mat",
)
def index_lines(spark, d):
    out = index_json(P.index_projection(mat(spark, d)))
    return out.select("source", "id", F.md5("json").alias("digest"))


@query(
    "read_index_table",
    """SELECT source, id, category, roughness FROM mat WHERE source = 'ambientcg' AND category = 'metal'
         AND roughness BETWEEN 0.2::DOUBLE AND 0.5::DOUBLE""",
    "mat",
)
def read_index_table(spark, d):
    path = run_dir(spark, "index")
    write_index_table(P.index_projection(mat(spark, d)), path)
    out = metadata.read_index_table(spark, path)
    keep = (F.col("source") == "ambientcg") & (F.col("category") == "metal")
    return out.filter(keep & F.col("roughness").between(0.2, 0.5)).select(
        "source", "id", "category", "roughness"
    )


@query(
    "resolve_physical",
    f"""
    SELECT source, id, physical_family, finish FROM (
      SELECT source, id, list_filter(list_transform(tags, lambda w: {sql_map(FAMILIES, "w")}),
          lambda x: x IS NOT NULL)[1] AS physical_family,
        list_filter(tags, lambda w: w IN ('hot', 'cold', 'old', 'new'))[1] AS finish FROM mat)
    WHERE physical_family = 'steel' AND finish = 'cold'""",
    "mat",
)
def resolve_physical(spark, d):
    families = spark.createDataFrame(list(FAMILIES.items()), "word string, physical_family string")
    return U.resolve_physical(U.physical_link(mat(spark, d), families, FINISHES), "steel", "cold")


@query(
    "write_catalog",
    """
    SELECT (SELECT count(*) FROM mat WHERE source = 'physicallybased' OR status <> 'failed') AS entries""",
    "mat",
)
def write_catalog(spark, d):
    """The written document has a table line per material that is not failed."""
    path = run_dir(spark, "catalog")
    doc = G.catalog(mat(spark, d), manifest_files(spark, d), rowmap(spark, d), "v2026.04.0", "2026-04-18")
    G.write_catalog(doc, path)
    lines = spark.read.text(path)
    is_entry = F.col("value").startswith("| ") & ~F.col("value").rlike(r"^\| (\| )?Material \|")
    return lines.agg(F.count_if(is_entry).alias("entries"))

