"""Payload, channel and bundle-packing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import payload as B
from assetlake.operators import quality as Q
from assetlake.operators import select as P
from assetlake.queries.registry import CHANNEL_OF_NO, mat, pick, query, table, tex
from assetlake.sinks import bundles as K

KEYS = ["source", "id", "tier", "category"]


@query(
    "hash_payloads",
    "SELECT source, id, channel, length, sha256 FROM tex",
    "tex",
)
def hash_payloads(spark, d):
    return P.with_hashes(tex(spark, d, payload=True)).select(
        "source", "id", "channel", "length", "sha256"
    )


@query(
    "texture_hashes",
    """
    SELECT source, id, string_agg(channel, ',' ORDER BY channel) AS maps,
      string_agg(channel || ':' || sha256 || ':' || length, ',' ORDER BY channel) AS hashes
    FROM tex GROUP BY source, id""",
    "tex",
)
def texture_hashes(spark, d):
    out = P.texture_hashes(tex(spark, d), ["source", "id"])
    text = F.transform(
        F.map_entries("texture_hashes"),
        lambda e: F.concat_ws(":", e["key"], e["value"]["sha256"], e["value"]["size"]),
    )
    return out.select(
        "source", "id", F.array_join("maps", ",").alias("maps"),
        F.array_join(text, ",").alias("hashes"),
    )


WIDE_SQL = ", ".join(
    f"max(CASE WHEN channel = '{c}' THEN length END) AS {c}" for c in S.CHANNELS
)


@query(
    "pivot_channels",
    f"SELECT source, id, tier, category, {WIDE_SQL} FROM tex GROUP BY source, id, tier, category",
    "tex",
)
def pivot_channels(spark, d):
    wide = K.pivot_channels(tex(spark, d, payload=True), KEYS)
    return wide.select(*KEYS, *[B.size(c).alias(c) for c in S.CHANNELS])


@query(
    "unpivot_channels",
    "SELECT source, id, tier, category, channel, sha256 FROM tex",
    "tex",
)
def unpivot_channels(spark, d):
    wide = K.pivot_channels(tex(spark, d), KEYS, "sha256")
    return K.unpivot_channels(wide, KEYS, "sha256")


@query(
    "magic_ok",
    """
    SELECT page_id, starts_with(html, '<!DO') AS doctype, starts_with(html, '<htm') OR
      starts_with(html, '<!DO') AS markup FROM pages""",
)
def magic_ok(spark, d):
    html = F.encode("html", "UTF-8")
    return table(spark, d, "pages").select(
        "page_id",
        B.has_magic(html, b"<!DO").alias("doctype"),
        B.has_magic(html, b"<htm", b"<!DO").alias("markup"),
    )


@query(
    "length_ok",
    "SELECT source, id, channel, length > 0 AND length <= 4000 AS ok FROM tex",
    "tex",
)
def length_ok(spark, d):
    return tex(spark, d).select("source", "id", "channel", B.length_ok("length", 4000).alias("ok"))


@query(
    "png_dimensions",
    """
    SELECT doc_id, n_chars AS width, n_chars * 2 + 1 AS height FROM documents""",
)
def png_dimensions(spark, d):
    """A PNG header is put in front of every text, with sizes taken from its length."""

    def be32(x):
        return F.unhex(F.lpad(F.hex(x), 8, "0"))

    head = F.concat(
        F.lit(bytes.fromhex("89504E470D0A1A0A0000000D49484452")), be32(F.col("n_chars")),
        be32(F.col("n_chars") * 2 + 1), F.encode("text", "UTF-8"),
    )
    dim = B.png_dimensions(head)
    return table(spark, d, "documents").select(
        "doc_id", dim["width"].cast("long").alias("width"), dim["height"].cast("long").alias("height")
    )


@query(
    "drop_invalid_channels",
    """
    SELECT m.source, m.id, coalesce(string_agg(t.channel, ',' ORDER BY t.channel), '') AS maps,
      CASE WHEN count(t.channel) = 0 OR max(m.status) = 'failed' THEN 'failed' ELSE 'ok' END AS status
    FROM mat m LEFT JOIN (SELECT * FROM tex WHERE regexp_matches(text, '^[A-M]')) t
      ON m.source = t.source AND m.id = t.id
    GROUP BY m.source, m.id""",
    "mat", "tex",
)
def drop_invalid_channels(spark, d):
    letter = F.decode(F.substring("payload", 1, 1), "ISO-8859-1")
    hashed = P.hashed_textures(tex(spark, d, payload=True), letter.between("A", "M"))
    records, _ = P.drop_invalid_channels(mat(spark, d), hashed.drop("payload"))
    return records.select("source", "id", F.array_join("maps", ",").alias("maps"), "status")


@query(
    "bundle_projection",
    f"""
    SELECT source, id, category, 1024 AS resolution_px, {WIDE_SQL}, '' AS source_url,
      'CC0-1.0' AS source_license, '7' AS baker_version, '2026-04-18T00:00:00+00:00' AS baked_at
    FROM tex GROUP BY source, id, category""",
    "tex",
)
def bundle_projection(spark, d):
    wide = K.pivot_channels(tex(spark, d, payload=True), KEYS)
    out = K.bundle_projection(wide, 1024, "7", "2026-04-18T00:00:00+00:00")
    return out.withColumns({c: B.size(c) for c in S.CHANNELS})


@query(
    "content_duplicates",
    """
    SELECT t.source, t.id, t.channel, t.sha256, g.copies,
      g.first.source || '/' || g.first.id || '/' || g.first.channel AS first
    FROM tex t JOIN (
      SELECT sha256, count(*) AS copies,
        min({'source': source, 'id': id, 'channel': channel}) AS first
      FROM tex GROUP BY sha256 HAVING count(*) > 1) g USING (sha256)""",
    "tex",
)
def content_duplicates(spark, d):
    out = Q.content_duplicates(tex(spark, d))
    first = F.concat_ws("/", "first.source", "first.id", "first.channel")
    return out.withColumn("first", first)


@query(
    "verify_hashes",
    f"""
    SELECT CAST(doc_id // 4 AS VARCHAR) AS id, channel, problem FROM (
      SELECT doc_id, {"list_extract([" + ", ".join(f"'{c}'" for c in CHANNEL_OF_NO) + "], CAST(doc_id % 4 AS INTEGER) + 1)"} AS channel,
        CASE WHEN lang = 'de' THEN 'size' WHEN regexp_matches(text, '[0-9]') THEN 'sha256' END AS problem
      FROM documents) WHERE problem IS NOT NULL""",
)
def verify_hashes(spark, d):
    """The index was made before digits were blanked and a byte was added to German texts."""
    docs = table(spark, d, "documents")
    changed = F.concat(
        F.regexp_replace("text", "[0-9]", "#"),
        F.when(F.col("lang") == "de", F.lit(".")).otherwise(""),
    )
    before, after = F.encode("text", "UTF-8"), F.encode(changed, "UTF-8")
    base = docs.select(
        F.lit("s").alias("source"),
        F.floor(F.col("doc_id") / 4).cast("string").alias("id"),
        pick(CHANNEL_OF_NO, F.col("doc_id")).alias("channel"),
        B.sha256(before).alias("sha256"), B.size(before).alias("length"),
        B.sha256(after).alias("new_sha256"), B.size(after).alias("new_length"),
    )
    from assetlake.operators.releases import verify_hashes as verify

    index = P.texture_hashes(base.drop("new_sha256", "new_length"), ["source", "id"])
    now = base.select("source", "id", "channel", F.col("new_sha256").alias("sha256"),
                      F.col("new_length").alias("length"))
    return verify(now, index).drop("source")
