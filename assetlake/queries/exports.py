"""Renderer exports, documents and the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import payload as B
from assetlake.functions import render as X
from assetlake.plans import catalog as G
from assetlake.queries.registry import manifest_files, mat, query, rowmap, table, tex
from assetlake.session import run_dir
from assetlake.sinks import bundles as K
from assetlake.sinks import documents as O
from assetlake.sinks.files import inventory


@query(
    "data_uri",
    "SELECT doc_id, 'data:image/png;base64,' || base64(encode(text)) AS uri FROM documents",
)
def data_uri(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", B.data_uri(F.encode("text", "UTF-8")).alias("uri")
    )


def materials(spark, d):
    """Index entries with the payload columns of their textures."""
    wide = K.pivot_channels(tex(spark, d, payload=True), ["source", "id"])
    wide = wide.withColumnsRenamed({c: f"t_{c}" for c in S.CHANNELS})
    return mat(spark, d).drop("category").join(wide, ["source", "id"], "left")


def scalars():
    names = ("metalness", "roughness", "color_hex", "ior")
    return {n: F.col(n) for n in names} | {"transmission": F.col("metalness") / F.lit(2.0)}


def textures():
    return {c: F.col(f"t_{c}") for c in S.CHANNELS}


WIDE_SQL = """
  , wide AS (SELECT source, id, {cols} FROM tex GROUP BY source, id),
  m AS (SELECT mat.*, {names} FROM mat LEFT JOIN wide USING (source, id))""".format(
    cols=", ".join(
        f"max(CASE WHEN channel = '{c}' THEN 'data:image/png;base64,' || base64(encode(text)) END) AS t_{c}"
        for c in S.CHANNELS
    ),
    names=", ".join(f"t_{c}" for c in S.CHANNELS),
)


def sql_object(*pairs: tuple[str, str]) -> str:
    """JSON object text with the non-null values only."""
    parts = ", ".join(f"'\"{k}\":' || {v}" for k, v in pairs)
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def sql_text(x: str) -> str:
    return f"'\"' || {x} || '\"'"


def sql_number(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


THREE = [("type", "'\"MeshPhysicalMaterial\"'"), ("metalness", sql_number("metalness")),
         ("roughness", sql_number("roughness")),
         ("color", "CAST(CAST('0x' || color_hex[2:] AS BIGINT) AS VARCHAR)"),
         ("ior", sql_number("ior")), ("transmission", sql_number("metalness / 2.0::DOUBLE"))]
THREE += [(row[1], sql_text(f"t_{row[0]}")) for row in S.CHANNEL_REGISTRY]


@query(
    "to_threejs",
    WIDE_SQL + f" SELECT source, id, md5({sql_object(*THREE)}) AS digest FROM m",
    "mat", "tex",
)
def to_threejs(spark, d):
    return materials(spark, d).select(
        "source", "id", F.md5(X.to_threejs(scalars(), textures())).alias("digest")
    )


def sql_ref(channel: str) -> str:
    return f"'{{\"source\":{{\"uri\":\"' || t_{channel} || '\"}}}}'"


def sql_rgba(i: int) -> str:
    at = 2 * i + 2
    return f"CAST(CAST('0x' || color_hex[{at}:{at + 1}] AS BIGINT) / 255.0::DOUBLE AS VARCHAR)"


PBR = [("metallicFactor", sql_number("metalness")), ("roughnessFactor", sql_number("roughness")),
       ("baseColorFactor", f"'[' || {sql_rgba(0)} || ',' || {sql_rgba(1)} || ',' || {sql_rgba(2)} || ',1.0]'"),
       ("baseColorTexture", sql_ref("color")),
       ("_note_metallicRoughnessTexture",
        f"CASE WHEN t_metalness IS NOT NULL AND t_roughness IS NOT NULL THEN '\"{X.PACKING_NOTE}\"' END")]
EXT = [("KHR_materials_ior", f"CASE WHEN ior IS NOT NULL THEN {sql_object(('ior', sql_number('ior')))} END"),
       ("KHR_materials_transmission",
        sql_object(("transmissionFactor", sql_number("metalness / 2.0::DOUBLE"))))]
GLTF = [("pbrMetallicRoughness", sql_object(*PBR)), ("extensions", sql_object(*EXT)),
        ("normalTexture", sql_ref("normal")), ("occlusionTexture", sql_ref("ao")),
        ("emissiveTexture", sql_ref("emission"))]


@query(
    "to_gltf",
    WIDE_SQL + f" SELECT source, id, md5({sql_object(*GLTF)}) AS digest FROM m",
    "mat", "tex",
)
def to_gltf(spark, d):
    return materials(spark, d).select(
        "source", "id", F.md5(X.to_gltf(scalars(), textures())).alias("digest")
    )


IMAGE = {
    "color": ("diffuseColor", "color3", ' colorspace="srgb_texture"'),
    "normal": ("normal", "vector3", ""),
    "roughness": ("roughness", "float", ""),
}


def sql_mtlx() -> str:
    """The preview-surface document for the three channels that occur in ``mat``."""
    nodes, links = "", ""
    for c, (usd, kind, space) in IMAGE.items():
        out = f"img_{c}"
        extra = ""
        if c == "normal":
            out = "normalmap_normal"
            extra = (
                '    <normalmap name="normalmap_normal" type="vector3">\n'
                '      <input name="in" type="vector3" nodename="img_normal" />\n    </normalmap>\n'
            )
        has = f"list_contains(maps, '{c}')"
        nodes += (
            f" || CASE WHEN {has} THEN '    <image name=\"img_{c}\" type=\"{kind}\">\n"
            f'      <input name="file" type="filename" value="\' || id || \'/{c}.png"{space} />\n'
            f"    </image>\n{extra}"
            f'    <output name="out_{c}" type="{kind}" nodename="{out}" />\n\' ELSE \'\' END'
        )
        links += (
            f" || CASE WHEN {has} THEN '    <input name=\"{usd}\" type=\"{kind}\" nodegraph=\"'"
            f" || id || '_textures\" output=\"out_{c}\" />\n' ELSE '' END"
        )

    def scalar(name: str, value: str) -> str:
        return (
            f" || CASE WHEN {value} IS NOT NULL THEN '    <input name=\"{name}\" type=\"float\" value=\"'"
            f" || CAST({value} AS VARCHAR) || '\" />\n' ELSE '' END"
        )

    rough = "CASE WHEN NOT list_contains(maps, 'roughness') THEN roughness END"
    inner = (
        "''" + scalar("roughness", rough) + scalar("metallic", "metalness") + scalar("ior", "ior") + links
    )
    return (
        "'<?xml version=''1.0'' encoding=''utf-8''?>\n<materialx version=\"1.38\">\n  <nodegraph name=\"'"
        " || id || '_textures\"' || CASE WHEN len(maps) = 0 THEN ' />\n' ELSE '>\n'"
        + nodes
        + " || '  </nodegraph>\n' END || '  <UsdPreviewSurface name=\"' || id || '_shader\" type=\"surfaceshader\">\n' || "
        + inner
        + " || '  </UsdPreviewSurface>\n  <surfacematerial name=\"' || id || '\" type=\"material\">\n"
        '    <input name="surfaceshader" type="surfaceshader" nodename="\' || id || \'_shader" />\n'
        "  </surfacematerial>\n</materialx>'"
    )


@query("to_mtlx", f"SELECT source, id, {sql_mtlx()} AS xml FROM mat", "mat")
def to_mtlx(spark, d):
    index = mat(spark, d)
    rows = index.select("source", "id", F.col("maps").alias("channels"))
    return O.synthesized_documents(rows, index)


def sql_rewritten() -> str:
    value = "regexp_extract(part, '^([^\"]*)', 1)"
    stem = (
        f"replace(replace(replace(lower(regexp_replace(list_extract(string_split({value}, '/'), -1),"
        " '\\.[^.]*$', '')), ' ', ''), '-', ''), '_', '')"
    )
    aliases = [(a.replace("_", ""), row[0]) for row in S.CHANNEL_REGISTRY for a in row[6]]
    found = " ".join(
        f"WHEN contains({stem}, '{a}') THEN '/t/' || page_id || '/{c}.png'"
        for a, c in aliases
        if c in ("color", "normal", "roughness", "displacement")
    )
    image = f"regexp_matches({value}, '(?i)^[^\"]*\\.(png|jpg|jpeg|tif|tiff|exr)$')"
    return (
        f"CASE WHEN {image} THEN CASE {found} ELSE {value} END ELSE {value} END"
        f" || substr(part, length({value}) + 1)"
    )


FILES = ["BaseColor.png", "wood_Normal-GL.JPG", "Rough ness.tif", "notes.txt", "x/y/Height.exr", "other.png"]


def upstream_documents(spark, d):
    """Documents made from pages: six file values around the page's URL."""
    parts = [F.lit("<d>"), F.col("url")]
    for i, f in enumerate(FILES):
        parts.append(F.lit(f'<input name="i{i}" value="lib/{f}" />'))
    parts += [F.col("html"), F.lit("</d>")]
    return table(spark, d, "pages").select(
        F.lit("s").alias("source"), F.col("page_id").cast("string").alias("id"),
        F.concat(*parts).alias("xml"),
    )


UPSTREAM_SQL = (
    "SELECT page_id, '<d>' || url || '"
    + "".join(f'<input name="i{i}" value="lib/{f}" />' for i, f in enumerate(FILES))
    + "' || html || '</d>' AS xml FROM pages"
)


@query(
    "rewrite_texture_paths",
    f"""
    SELECT CAST(page_id AS VARCHAR) AS id, parts[1] || list_aggregate(list_transform(parts[2:],
        lambda part: 'value="' || {sql_rewritten()}), 'string_agg', '') AS xml
    FROM (SELECT page_id, string_split(xml, 'value="') AS parts FROM ({UPSTREAM_SQL}))""",
)
def rewrite_texture_paths(spark, d):
    present = ["color", "normal", "roughness", "displacement"]
    docs = upstream_documents(spark, d)
    rows = docs.select("source", "id", F.array(*[F.lit(c) for c in present]).alias("channels"))
    return O.original_documents(rows, docs, "/t").select("id", "xml")


@query(
    "attribute_comment",
    """
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '<?xml version="1.0"?>' || chr(10) || c || html
      ELSE c || html END AS xml
    FROM (SELECT *, '<!-- source: ' || url || ' -->' || chr(10) || '<!-- license: TBV -->' || chr(10) ||
      '<!-- material: ' || page_id || ' -->' || chr(10) || '<!-- fetched-by: assetlake -->' || chr(10) AS c
      FROM pages)""",
)
def attribute_comment(spark, d):
    head = F.when(F.col("page_id") % 2 == 0, F.lit('<?xml version="1.0"?>')).otherwise("")
    return table(spark, d, "pages").select(
        "page_id",
        X.attribute_comment(
            F.concat(head, "html"), F.col("page_id").cast("string"), "url", F.lit("TBV")
        ).alias("xml"),
    )


@query(
    "pack_documents",
    """
    SELECT 's' || page_id % 3 AS source, split_part(url, '/', 3) AS id, arg_max(md5(html), path) AS digest
    FROM (SELECT *, printf('%08d', page_id) AS path FROM pages) GROUP BY 1, 2""",
)
def pack_documents(spark, d):
    pages = table(spark, d, "pages").select(
        F.concat(F.lit("s"), (F.col("page_id") % 3).cast("string")).alias("source"),
        F.get(F.split("url", "/"), F.lit(2)).alias("id"),
        F.lpad(F.col("page_id").cast("string"), 8, "0").alias("path"),
        F.col("html").alias("xml"),
    )
    return O.pack_documents(pages).select("source", "id", F.md5("xml").alias("digest"))


def page_documents(spark, d):
    """(source, id, path, xml): every page as the document of a material."""
    return table(spark, d, "pages").select(
        F.concat(F.lit("s"), (F.col("page_id") % 3).cast("string")).alias("source"),
        F.col("page_id").cast("string").alias("id"),
        F.col("url").alias("path"),
        F.col("html").alias("xml"),
    )


@query(
    "document_map",
    """
    SELECT 's' || page_id % 3 || '-mtlx.json' AS file, CAST(page_id AS VARCHAR) AS id, sha256(html) AS sha256
    FROM pages""",
)
def document_map(spark, d):
    back = F.from_json("content", "map<string, string>")
    rows = O.document_map(page_documents(spark, d)).select("file", F.explode(back).alias("id", "xml"))
    return rows.select("file", "id", F.sha2(F.encode("xml", "UTF-8"), 256).alias("sha256"))


@query(
    "document_files",
    """
    SELECT file, octet_length(encode(content)) AS length, sha256(content) AS sha256 FROM (
      SELECT 's' || page_id % 3 || '-mtlx.json' AS file, '{' || string_agg(CAST(to_json(CAST(page_id AS VARCHAR))
        AS VARCHAR) || ':' || CAST(to_json(html) AS VARCHAR), ',' ORDER BY CAST(page_id AS VARCHAR)) || '}' AS content
      FROM pages GROUP BY 1)""",
)
def document_files(spark, d):
    """One map per source, written in parts of some pages and joined, against the map as one value."""
    path = run_dir(spark, "documents")
    O.write_document_maps(page_documents(spark, d), path, part_bytes=20_000)
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.sha2("content", 256).alias("sha256")
    )


@query(
    "export_documents",
    """
    SELECT id || '/' || channel || '.png' AS file, octet_length(encode(text)) AS length FROM tex
    UNION ALL
    SELECT DISTINCT id || '/' || id || '.mtlx', -1 FROM tex""",
    "tex",
)
def export_documents(spark, d):
    path = run_dir(spark, "export")
    O.export_documents(tex(spark, d, payload=True), mat(spark, d), path)
    document = F.endswith("file", F.lit(".mtlx"))
    return inventory(spark, path).withColumn(
        "length", F.when(document, F.lit(-1).cast("long")).otherwise(F.col("length"))
    )


@query(
    "registry_maps",
    f"""
    SELECT channel, threejs, gltf, mtlx, usd, usd_type, n_documents FROM (VALUES
      {", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row[:6]) + ")" for row in S.CHANNEL_REGISTRY)})
      r(channel, threejs, gltf, mtlx, usd, usd_type)
    JOIN (SELECT channel, count(*) AS n_documents FROM tex GROUP BY channel) USING (channel)""",
    "tex",
)
def registry_maps(spark, d):
    counts = tex(spark, d).groupBy("channel").agg(F.count(F.lit(1)).alias("n_documents"))
    registry = S.registry_df(spark).drop("channel_no", "aliases")
    return registry.join(counts, "channel")


# --- catalogue -----------------------------------------------------------------------------


@query(
    "catalog_cells",
    """
    SELECT id, '[' || name || '](' || CASE source WHEN 'ambientcg' THEN 'https://ambientcg.com/a/' || id
        WHEN 'polyhaven' THEN 'https://polyhaven.com/a/' || id
        WHEN 'gpuopen' THEN 'https://matlib.gpuopen.com/main/materials/all?material=' || id
        ELSE 'https://physicallybased.info' END || ')' AS link,
      '![color](../mtlx/' || source || '/' || id || '/color_thumb.png)' AS thumb,
      coalesce(printf('%.2f', roughness), '—') AS roughness, printf('%.1f', metalness) AS metalness,
      coalesce(printf('%.2f', ior), '—') AS ior
    FROM mat""",
    "mat",
)
def catalog_cells(spark, d):
    return mat(spark, d).select(
        "id",
        X.material_link("source", "id", "name").alias("link"),
        X.thumb_img("source", "id", "color").alias("thumb"),
        X.fmt_scalar("roughness", 2).alias("roughness"),
        X.fmt_scalar("metalness", 1).alias("metalness"),
        X.fmt_scalar("ior", 2).alias("ior"),
    )


@query(
    "catalog_sections",
    """
    , ok AS (SELECT * FROM mat WHERE source = 'physicallybased' OR status <> 'failed'),
    cells AS (SELECT *, CASE source WHEN 'ambientcg' THEN 0 WHEN 'polyhaven' THEN 1 WHEN 'gpuopen' THEN 2
      ELSE 3 END AS source_no,
      EXISTS (SELECT 1 FROM tex t WHERE t.source = ok.source AND t.id = ok.id AND channel = 'color') AS has
      FROM ok),
    counts AS (SELECT source_no, category, count(*) AS n FROM cells GROUP BY ALL),
    head AS (SELECT source_no, source, count(*) AS n FROM cells GROUP BY ALL)
    SELECT source_no, '' AS category, 0 AS part, '' AS id, line_no, CASE line_no
        WHEN 0 THEN '## ' || CASE source WHEN 'ambientcg' THEN '🪨' WHEN 'polyhaven' THEN '🏔️'
            WHEN 'gpuopen' THEN '💎' ELSE '⚛️' END || ' ' || source ||
            CASE WHEN source_no = 3 THEN ' — scalar properties' ELSE '' END
        WHEN 2 THEN '> ' || n || CASE WHEN source_no = 3
            THEN ' materials | No textures — IOR, roughness, metalness, color values'
            ELSE ' materials | Tiers: 1k | License: ' || CASE WHEN source_no = 2 THEN 'TBV (per material)'
              ELSE 'CC0-1.0' END END
        WHEN 3 THEN '> [' || site || '](' || site || ')' ELSE '' END AS line
    FROM (SELECT *, CASE source WHEN 'gpuopen' THEN 'https://matlib.gpuopen.com'
        WHEN 'physicallybased' THEN 'https://physicallybased.info'
        ELSE 'https://' || source || '.com' END AS site FROM head),
      (VALUES (0), (1), (2), (3), (4)) v(line_no)
    UNION ALL
    SELECT source_no, category, 0, '', line_no, CASE line_no
        WHEN 0 THEN '<details><summary><b>' || category || '</b> (' || n || ')</summary>'
        WHEN 2 THEN CASE WHEN source_no = 3 THEN '| Material | Color | Roughness | Metalness | IOR |'
          ELSE '| | Material | Maps | Category |' END
        WHEN 3 THEN CASE WHEN source_no = 3 THEN '|---|---|---|---|---|' ELSE '|---|---|---|---|' END
        ELSE '' END
    FROM counts, (VALUES (0), (1), (2), (3)) v(line_no)
    UNION ALL
    SELECT source_no, category, 2, '', line_no, CASE line_no WHEN 1 THEN '</details>' ELSE '' END
    FROM counts, (VALUES (0), (1), (2)) v(line_no)
    UNION ALL
    SELECT source_no, category, 1, id, 0, CASE WHEN source_no = 3 THEN
        '| ' || name || ' | `' || color_hex || '` | ' || coalesce(printf('%.2f', roughness), '—') || ' | ' ||
        printf('%.1f', metalness) || ' | ' || coalesce(printf('%.2f', ior), '—') || ' |'
      ELSE '| ' || CASE WHEN has THEN '![color](../mtlx/' || source || '/' || id || '/color_thumb.png)'
          ELSE '—' END || ' | [' || name || '](' || CASE source_no WHEN 2
          THEN 'https://matlib.gpuopen.com/main/materials/all?material=' || id
          ELSE 'https://' || source || '.com/a/' || id END || ') | ' || array_to_string(maps, ', ') ||
          ' | ' || category || ' |' END
    FROM cells""",
    "mat", "tex",
)
def catalog_sections(spark, d):
    out = G.sections(mat(spark, d), manifest_files(spark, d), rowmap(spark, d))
    return out.orderBy(*G.ORDER)


@query(
    "catalog_header",
    """
    SELECT line_no, CASE line_no
        WHEN 0 THEN '<!-- generated, do not edit -->'
        WHEN 1 THEN '<!-- Source: release v2026.04.0 | Generated: 2026-04-18 -->'
        WHEN 3 THEN '# Material Catalog'
        WHEN 5 THEN '> **' || n || '** materials across **' || s || '** sources, **' || t ||
          '** resolution tiers.'
        WHEN 7 THEN '**Quick links:** ' || links ELSE '' END AS line
    FROM (SELECT count(*) AS n, count(DISTINCT source) AS s FROM mat),
      (SELECT count(DISTINCT tier) AS t FROM tex),
      (SELECT string_agg('[' || CASE source WHEN 'ambientcg' THEN '🪨' WHEN 'polyhaven' THEN '🏔️'
          WHEN 'gpuopen' THEN '💎' ELSE '⚛️' END || ' ' || source || '](#' || source || ')', ' | '
          ORDER BY source) AS links FROM (SELECT DISTINCT source FROM mat)),
      (SELECT unnest(range(9)) AS line_no)""",
    "mat", "tex",
)
def catalog_header(spark, d):
    out = G.header(mat(spark, d), manifest_files(spark, d), "v2026.04.0", "2026-04-18")
    return out.select(F.col("line_no").cast("long").alias("line_no"), "line")


