"""Registry of queries and the catalogue views they read.

The given tables stand in for catalogue data: ``part`` for index entries, ``documents`` for texture
payloads, ``orders`` for look-up requests, ``events`` for run logs. Each view exists twice, as a
DataFrame and as SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.functions.names import asset_name, bundle_pattern, rowmap_pattern
from assetlake.functions.payload import sha256, size
from assetlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Register a query and, where SQL can express it, the SQL over the named views."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, *views)
        return fn

    return add


def with_views(sql: str, *views: str) -> str:
    needed: list[str] = []

    def need(v: str) -> None:
        for dep in VIEW_DEPS.get(v, []):
            need(dep)
        if v not in needed:
            needed.append(v)

    for v in views:
        need(v)
    if not needed:
        return sql
    body = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in needed)
    return f"WITH RECURSIVE {body}\n{sql}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Keyword dictionary over the words that occur in part names.
WORDS = {
    "anvil": "metal", "bolt": "metal", "gear": "metal", "plate": "ceramic", "ring": "stone",
    "rod": "wood", "widget": "plastic", "gizmo": "plastic", "blue": "glass", "old": "organic",
}
SOURCE_OF_TYPE = {
    "ECONOMY": "ambientcg", "LARGE": "ambientcg", "MEDIUM": "polyhaven",
    "PROMO": "physicallybased", "SMALL": "gpuopen", "STANDARD": "polyhaven",
}
CHANNEL_OF_NO = ["color", "normal", "roughness", "ao"]
CATEGORY_OF_NO = ["other", "other", "other", "other", "metal", "wood", "stone", "fabric", "glass"]
SOURCE_OF_NO = ["ambientcg", "ambientcg", "polyhaven", "gpuopen"]


def pick(values: list[str], n: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(n, F.lit(len(values))).cast("int"))


def sql_pick(values: list[str], n: str) -> str:
    inner = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{inner}], CAST(({n}) % {len(values)} AS INTEGER) + 1)"


def sql_map(mapping: dict[str, str], x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {x} {cases} END"


def sql_category(raw: str) -> str:
    """First known word of a raw category, SQL side."""
    word = sql_map(WORDS, "w")
    return (
        f"coalesce(list_filter(list_transform(string_split(lower(trim(split_part({raw}, '/', 1))),"
        f" ' '), lambda w: {word}), lambda c: c IS NOT NULL)[1], 'other')"
    )


def mat(spark: SparkSession, d: str) -> DataFrame:
    """Index entries from parts; a third and more of them come from one source."""
    from assetlake.functions.normalize import lookup, normalize_category

    p = table(spark, d, "part")
    key, n = F.col("p_partkey"), F.col("p_size")
    source = lookup(F.col("p_type"), SOURCE_OF_TYPE)
    textured = F.col("p_type") != "PROMO"

    def when(c: Column, v: str) -> Column:
        return F.when(c & textured, F.lit(v))

    tiers = [when(n >= 0, "1k"), when(n >= 20, "2k"), when(n >= 35, "4k"), when(n >= 45, "8k")]
    maps = [when(n % 5 != 0, "color"), when(n % 2 == 0, "normal"), when(n % 3 == 0, "roughness")]
    return p.select(
        key.cast("string").alias("id"),
        source.alias("source"),
        F.col("p_name").alias("name"),
        normalize_category("p_name", WORDS).alias("category"),
        F.split("p_name", " ").alias("tags"),
        F.concat(F.lit("https://example.org/"), key.cast("string")).alias("source_url"),
        F.when(source == "gpuopen", "TBV").otherwise("CC0-1.0").alias("source_license"),
        F.array_compact(F.array(*tiers)).alias("available_tiers"),
        F.array_compact(F.array(*maps)).alias("maps"),
        F.when(n % 4 == 0, "").otherwise("2026-04-18").alias("last_updated"),
        F.format_string("#%06X", (key * 7919) % 16777216).alias("color_hex"),
        F.when(key % 7 != 0, n / F.lit(50.0)).alias("roughness"),
        ((key % 101) / F.lit(100.0)).alias("metalness"),
        F.when(key % 3 != 0, F.lit(1.0) + (key % 200) / F.lit(100.0)).alias("ior"),
        F.when(key % 13 == 0, "failed").otherwise("ok").alias("status"),
    )


def tex(spark: SparkSession, d: str, payload: bool = False) -> DataFrame:
    """Long textures from documents: four documents make up one material."""
    t = table(spark, d, "documents")
    m = F.floor(F.col("doc_id") / 4)
    bytes_ = F.encode("text", "UTF-8")
    cols = [
        pick(SOURCE_OF_NO, m).alias("source"),
        m.cast("string").alias("id"),
        F.lit("1k").alias("tier"),
        pick(CATEGORY_OF_NO, m).alias("category"),
        pick(CHANNEL_OF_NO, F.col("doc_id")).alias("channel"),
        size(bytes_).alias("length"),
        sha256(bytes_).alias("sha256"),
    ]
    return t.select(*cols, *([bytes_.alias("payload")] if payload else []))


def rowmap(spark: SparkSession, d: str) -> DataFrame:
    """Rowmap of ``tex``: payloads of a bundle lie back to back by id and channel."""
    from assetlake.operators.chunking import payload_offsets

    named = tex(spark, d).withColumn("parquet_file", asset_name("source", "tier", "category"))
    return payload_offsets(named, order=("id", "channel")).withColumn(
        "release_tag", F.lit("v2026.04.0")
    )


def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """Manifest rows: a bundle and a rowmap per cell of ``tex``."""
    from assetlake.functions.names import rowmap_name

    cells = tex(spark, d).select("source", "tier", "category").distinct()
    named = cells.withColumn("b", asset_name("source", "tier", "category"))
    kinds = F.array(
        F.struct(F.lit("bundle").alias("kind"), F.col("b").alias("file_name")),
        F.struct(F.lit("rowmap").alias("kind"), rowmap_name("b").alias("file_name")),
    )
    return named.select(
        F.lit("v2026.04.0").alias("release_tag"), "tier",
        F.lit("https://example.org/r/").alias("base_url"), "source", F.explode(kinds).alias("k"),
    ).select("release_tag", "tier", "base_url", "source", "k.*")


def asset_names(spark: SparkSession, d: str) -> DataFrame:
    """File names of a release: bundles and rowmaps of all documents, with page names among them."""
    from assetlake.functions.names import rowmap_name

    docs = table(spark, d, "documents")
    m = F.floor(F.col("doc_id") / 4)
    tier = pick(["1k", "ktx2-1k", "2k"], m)
    chunk = (F.floor(F.col("n_chars") / 4000) + 1).cast("int")
    bundle = asset_name(F.col("source"), tier, pick(CATEGORY_OF_NO, m), chunk)
    has_rowmap = F.col("lang") != "fr"
    names = F.array_compact(
        F.array(bundle, F.when(has_rowmap, rowmap_name(bundle)))
    )
    pages = table(spark, d, "pages").select(F.substring_index("url", "/", -1).alias("file_name"))
    return docs.select(F.explode(names).alias("file_name")).union(pages).distinct()


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(old, new) hashed textures: materials with a toxic document are removed, those with two poor
    ones are new, and digits of the texts were blanked in between."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    m = F.floor(F.col("doc_id") / 4)

    def hashed(rows: DataFrame, text: Column) -> DataFrame:
        return rows.select(
            pick(SOURCE_OF_NO, m).alias("source"),
            m.cast("string").alias("id"),
            pick(CHANNEL_OF_NO, F.col("doc_id")).alias("channel"),
            sha256(F.encode(text, "UTF-8")).alias("sha256"),
        )

    def without(test: str, at_least: int) -> DataFrame:
        bad = labels.filter(test).groupBy(m.alias("m")).count().filter(F.col("count") >= at_least)
        return docs.withColumn("m", m).join(bad, "m", "left_anti")

    old = hashed(without("quality = 0", 2), F.col("text"))
    new = hashed(without("toxic = 1", 1), F.regexp_replace("text", "[0-9]", "#"))
    return old, new


def requests(spark: SparkSession, d: str) -> DataFrame:
    """Look-up requests from orders; some miss the tier, the source, the id or the channel."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    m = F.floor(F.col("o_custkey") / 2)
    return o.select(
        key.alias("request"),
        F.when(status == "P", F.lit("unknown")).otherwise(pick(SOURCE_OF_NO, m)).alias("source"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("16k")).otherwise("1k").alias("tier"),
        m.cast("string").alias("id"),
        pick([*CHANNEL_OF_NO, "emission"], key).alias("channel"),
    )


def inventory(spark: SparkSession, d: str) -> DataFrame:
    """Cache files from documents; those of German ones count as metadata files."""
    from assetlake.operators.usage import parse_inventory

    docs = table(spark, d, "documents")
    tag = pick(["v2026.04.0", "v2026.05.0", "v2026.05.1"], F.floor(F.col("doc_id") / 100))
    payload = F.concat_ws(
        "/", tag, "source", pick(["1k", "2k"], F.col("doc_id")), F.col("doc_id").cast("string"),
        F.lit("color.png"),
    )
    meta = F.concat_ws("/", tag, F.lit(".rowmaps"), F.concat("source", F.lit(".json")))
    file = F.when(F.col("lang") == "de", meta).otherwise(payload)
    return parse_inventory(
        docs.select(file.alias("file"), F.octet_length("text").cast("long").alias("length"))
    )


def log(spark: SparkSession, d: str) -> DataFrame:
    """Run log from events."""
    return table(spark, d, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("id"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("run"),
        (F.col("event_type") != "error").alias("ok"),
        F.rint(F.col("value") * 100).cast("long").alias("bytes"),
        "event_id",
    )


_m = "(doc_id // 4)"
VIEW_SQL = {
    "mat": f"""
      SELECT CAST(p_partkey AS VARCHAR) AS id, {sql_map(SOURCE_OF_TYPE, "p_type")} AS source,
        p_name AS name, {sql_category("p_name")} AS category, string_split(p_name, ' ') AS tags,
        'https://example.org/' || p_partkey AS source_url,
        CASE WHEN p_type = 'SMALL' THEN 'TBV' ELSE 'CC0-1.0' END AS source_license,
        CASE WHEN p_type = 'PROMO' THEN []::VARCHAR[] ELSE
          list_filter(['1k', CASE WHEN p_size >= 20 THEN '2k' END, CASE WHEN p_size >= 35 THEN '4k' END,
            CASE WHEN p_size >= 45 THEN '8k' END], lambda x: x IS NOT NULL) END AS available_tiers,
        CASE WHEN p_type = 'PROMO' THEN []::VARCHAR[] ELSE
          list_filter([CASE WHEN p_size % 5 <> 0 THEN 'color' END,
            CASE WHEN p_size % 2 = 0 THEN 'normal' END,
            CASE WHEN p_size % 3 = 0 THEN 'roughness' END], lambda x: x IS NOT NULL) END AS maps,
        CASE WHEN p_size % 4 = 0 THEN '' ELSE '2026-04-18' END AS last_updated,
        printf('#%06X', (p_partkey * 7919) % 16777216) AS color_hex,
        CASE WHEN p_partkey % 7 <> 0 THEN p_size / 50.0::DOUBLE END AS roughness,
        (p_partkey % 101) / 100.0::DOUBLE AS metalness,
        CASE WHEN p_partkey % 3 <> 0 THEN 1.0::DOUBLE + (p_partkey % 200) / 100.0::DOUBLE END AS ior,
        CASE WHEN p_partkey % 13 = 0 THEN 'failed' ELSE 'ok' END AS status
      FROM part""",
    "tex": f"""
      SELECT {sql_pick(SOURCE_OF_NO, _m)} AS source, CAST({_m} AS VARCHAR) AS id, '1k' AS tier,
        {sql_pick(CATEGORY_OF_NO, _m)} AS category, {sql_pick(CHANNEL_OF_NO, "doc_id")} AS channel,
        octet_length(encode(text)) AS length, sha256(text) AS sha256, text
      FROM documents""",
    "rowmap": """
      SELECT source, id, tier, category, channel, length, sha256,
        'assetlake-' || source || '-' || tier || '-' || category || '.parquet' AS parquet_file,
        CAST(coalesce(sum(length) OVER (PARTITION BY source, tier, category ORDER BY id, channel
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
        'v2026.04.0' AS release_tag
      FROM tex""",
    "manifest_files": """
      SELECT 'v2026.04.0' AS release_tag, tier, source, kind,
        CASE kind WHEN 'bundle' THEN 'assetlake-' || c || '.parquet' ELSE c || '-rowmap.json' END
          AS file_name
      FROM (SELECT DISTINCT source, tier, source || '-' || tier || '-' || category AS c FROM tex),
        (VALUES ('bundle'), ('rowmap')) k(kind)""",
    "asset_names": f"""
      SELECT DISTINCT file_name FROM (
        SELECT unnest(CASE WHEN lang <> 'fr' THEN ['assetlake-' || s || '.parquet', s || '-rowmap.json']
          ELSE ['assetlake-' || s || '.parquet'] END) AS file_name
        FROM (SELECT lang, source || '-' || {sql_pick(["1k", "ktx2-1k", "2k"], _m)} || '-' ||
          {sql_pick(CATEGORY_OF_NO, _m)} || '-' || (n_chars // 4000 + 1) AS s FROM documents)
        UNION ALL SELECT list_extract(string_split(url, '/'), -1) FROM pages)""",
    "parsed": " UNION ALL ".join(
        f"""
      SELECT file_name, '{kind}' AS kind, m.source, m.tier, m.category,
        CAST(nullif(m.chunk, '') AS INTEGER) AS chunk
      FROM (SELECT file_name, regexp_extract(file_name, '{pattern}',
          ['source', 'tier', 'category', 'chunk']) AS m
        FROM asset_names WHERE regexp_matches(file_name, '{pattern}'))"""
        for kind, pattern in (("bundle", bundle_pattern()), ("rowmap", rowmap_pattern()))
    ),
    "snap_old": f"""
      SELECT {sql_pick(SOURCE_OF_NO, _m)} AS source, CAST({_m} AS VARCHAR) AS id,
        {sql_pick(CHANNEL_OF_NO, "doc_id")} AS channel, sha256(text) AS sha256
      FROM documents WHERE doc_id // 4 NOT IN (SELECT doc_id // 4 FROM labels WHERE quality = 0
        GROUP BY 1 HAVING count(*) >= 2)""",
    "snap_new": f"""
      SELECT {sql_pick(SOURCE_OF_NO, _m)} AS source, CAST({_m} AS VARCHAR) AS id,
        {sql_pick(CHANNEL_OF_NO, "doc_id")} AS channel,
        sha256(regexp_replace(text, '[0-9]', '#', 'g')) AS sha256
      FROM documents WHERE doc_id // 4 NOT IN (SELECT doc_id // 4 FROM labels WHERE toxic = 1)""",
    "diff": """
      SELECT source, id, CASE WHEN count(old_hash) = 0 THEN 'new'
          WHEN count(new_hash) = 0 THEN 'removed'
          WHEN count(*) FILTER (WHERE old_hash IS DISTINCT FROM new_hash) > 0 THEN 'changed'
          ELSE 'unchanged' END AS change
      FROM (SELECT source, id, channel, o.sha256 AS old_hash, n.sha256 AS new_hash
            FROM snap_old o FULL JOIN snap_new n USING (source, id, channel))
      GROUP BY source, id""",
    "requests": f"""
      SELECT o_orderkey AS request,
        CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE {sql_pick(SOURCE_OF_NO, "o_custkey // 2")} END
          AS source,
        CASE WHEN o_orderpriority = '1-URGENT' THEN '16k' ELSE '1k' END AS tier,
        CAST(o_custkey // 2 AS VARCHAR) AS id,
        {sql_pick([*CHANNEL_OF_NO, "emission"], "o_orderkey")} AS channel
      FROM orders""",
    "inventory": f"""
      SELECT tag, CASE WHEN NOT is_meta THEN source END AS source, CASE WHEN NOT is_meta THEN tier END
          AS tier, is_meta, length,
        CASE WHEN is_meta THEN tag || '/.rowmaps/' || source || '.json'
          ELSE tag || '/' || source || '/' || tier || '/' || doc_id || '/color.png' END AS file
      FROM (SELECT doc_id, source, lang = 'de' AS is_meta, {sql_pick(["1k", "2k"], "doc_id")} AS tier,
          {sql_pick(["v2026.04.0", "v2026.05.0", "v2026.05.1"], "doc_id // 100")} AS tag,
          octet_length(encode(text)) AS length FROM documents)""",
    "log": """
      SELECT ts, CAST(user_id AS VARCHAR) AS id, CAST(user_id % 4 AS INTEGER) AS run,
        event_type <> 'error' AS ok, CAST(round_even(value * 100, 0) AS BIGINT) AS bytes, event_id
      FROM events""",
}
VIEW_DEPS = {
    "rowmap": ["tex"],
    "manifest_files": ["tex"],
    "parsed": ["asset_names"],
    "diff": ["snap_old", "snap_new"],
}
