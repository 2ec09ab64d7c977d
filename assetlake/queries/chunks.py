"""Bundle planning queries: sizes, chunks, offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions.names import parse_asset_name
from assetlake.operators import chunking as C
from assetlake.queries.registry import query, rowmap, table, tex

LIMIT = 60_000
SIZES_SQL = """
  SELECT source, tier, category, id, CAST(sum(length) AS BIGINT) AS length FROM tex
  GROUP BY source, tier, category, id"""


@query(
    "estimate_size",
    """SELECT source, tier, category, CAST(sum(length) AS BIGINT) AS bytes FROM tex
       GROUP BY source, tier, category""",
    "tex",
)
def estimate_size(spark, d):
    return C.estimate_size(tex(spark, d))


@query("material_sizes", SIZES_SQL, "tex")
def material_sizes(spark, d):
    return C.material_sizes(tex(spark, d))


COUNT_SQL = f"""
  SELECT source, tier, category, id, length, total > {LIMIT} AS numbered,
    CAST((rn - 1) // CASE WHEN total > {LIMIT} THEN greatest(n // (total // {LIMIT} + 1), 1)
      ELSE n END + 1 AS INTEGER) AS chunk
  FROM (SELECT *, row_number() OVER (PARTITION BY source, tier, category ORDER BY id) AS rn,
      count(*) OVER (PARTITION BY source, tier, category) AS n,
      CAST(sum(length) OVER (PARTITION BY source, tier, category) AS BIGINT) AS total
    FROM ({SIZES_SQL}))"""


@query("chunk_by_count", COUNT_SQL, "tex")
def chunk_by_count(spark, d):
    return C.chunk_by_count(C.material_sizes(tex(spark, d)), max_bytes=LIMIT)


# Greedy rotation over all parts by type, one step of the recursion per part of a type.
GREEDY_SQL = """
  , pos AS (SELECT p_type AS category, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS BIGINT) AS length,
      row_number() OVER (PARTITION BY p_type ORDER BY CAST(p_partkey AS VARCHAR)) AS rn FROM part),
  walk AS (
    SELECT category, id, length, rn, 1 AS chunk, length AS used FROM pos WHERE rn = 1
    UNION ALL
    SELECT p.category, p.id, p.length, p.rn, w.chunk + CASE WHEN w.used >= 500 THEN 1 ELSE 0 END,
      CASE WHEN w.used >= 500 THEN 0 ELSE w.used END + p.length
    FROM walk w JOIN pos p ON p.category = w.category AND p.rn = w.rn + 1)
  SELECT 'src' AS source, '1k' AS tier, category, id, length, chunk FROM walk"""


@query("chunk_by_bytes", "WITH RECURSIVE one AS (SELECT 1)" + GREEDY_SQL)
def chunk_by_bytes(spark, d):
    p = table(spark, d, "part").select(
        F.lit("src").alias("source"), F.lit("1k").alias("tier"), F.col("p_type").alias("category"),
        F.col("p_partkey").cast("string").alias("id"), F.col("p_size").cast("long").alias("length"),
    )
    return C.chunk_by_bytes(p, max_bytes=500)


BLOCKS_SQL = """
  WITH RECURSIVE pos AS (SELECT c_mktsegment AS category, CAST(c_custkey AS VARCHAR) AS id,
      CAST(round(abs(c_acctbal)) AS BIGINT) AS length,
      row_number() OVER (PARTITION BY c_mktsegment ORDER BY CAST(c_custkey AS VARCHAR)) AS rn FROM customer),
  walk AS (
    SELECT category, id, length, rn, 1 AS chunk, length AS used FROM pos WHERE rn = 1
    UNION ALL
    SELECT p.category, p.id, p.length, p.rn, w.chunk + CASE WHEN w.used >= 25000 THEN 1 ELSE 0 END,
      CASE WHEN w.used >= 25000 THEN 0 ELSE w.used END + p.length
    FROM walk w JOIN pos p ON p.category = w.category AND p.rn = w.rn + 1)
  SELECT 'src' AS source, '1k' AS tier, category, id, length, chunk FROM walk"""


@query("chunk_by_bytes_blocks", BLOCKS_SQL)
def chunk_by_bytes_blocks(spark, d):
    """Few large groups, each cut into many blocks of ten rows that pass on where their chunks began."""
    c = table(spark, d, "customer").select(
        F.lit("src").alias("source"), F.lit("1k").alias("tier"), F.col("c_mktsegment").alias("category"),
        F.col("c_custkey").cast("string").alias("id"), F.round(F.abs("c_acctbal")).cast("long").alias("length"),
    )
    return C.chunk_by_bytes(c, max_bytes=25_000, block_rows=10)


@query(
    "chunk_bounds",
    f"""
    SELECT source, tier, category, chunk, bool_or(numbered) AS numbered, min(id) AS first_id,
      max(id) AS last_id, count(*) AS n, CAST(sum(length) AS BIGINT) AS bytes,
      'assetlake-' || source || '-' || tier || '-' || category ||
        CASE WHEN bool_or(numbered) THEN '-' || chunk ELSE '' END || '.parquet' AS parquet_file
    FROM ({COUNT_SQL}) GROUP BY source, tier, category, chunk""",
    "tex",
)
def chunk_bounds(spark, d):
    return C.bundle_files(C.chunk_bounds(chunk_by_count(spark, d)))


@query(
    "alpha_subsplit",
    """
    SELECT p_partkey, CASE WHEN upper(substr(p_name, 1, 1)) BETWEEN 'A' AND 'M' THEN 'A-M'
      WHEN upper(substr(p_name, 1, 1)) BETWEEN 'N' AND 'Z' THEN 'N-Z' ELSE '0-9' END AS letters
    FROM part""",
)
def alpha_subsplit(spark, d):
    rows = table(spark, d, "part").withColumn("id", F.col("p_name"))
    return C.alpha_subsplit(rows).select("p_partkey", "letters")


# Parts as materials of the 8k tier, by brand; brands beyond the limit are split by first letters.
LETTER_LIMIT = 400
LETTERS_SQL = f"""
  SELECT category, letter, CASE WHEN total <= {LETTER_LIMIT} THEN NULL WHEN part < 0 THEN '0-9' ELSE
      CASE WHEN part = min(part) OVER (PARTITION BY category, part >= 0) THEN 'A' ELSE first END || '-' ||
      coalesce(chr(ascii(min(first) OVER (PARTITION BY category, part >= 0 ORDER BY part
        RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) - 1), 'Z') END AS letters
  FROM (SELECT *, min(letter) OVER (PARTITION BY category, part) AS first
    FROM (SELECT category, letter, total, CASE WHEN letter = '0' THEN -1
        ELSE CAST(floor(before * ceil(total / {LETTER_LIMIT}) / total) AS INTEGER) END AS part
      FROM (SELECT category, letter, sum(b) OVER (PARTITION BY category) AS total,
          sum(b) OVER (PARTITION BY category ORDER BY letter) - b AS before
        FROM (SELECT p_brand AS category, CASE WHEN regexp_matches(upper(substr(p_name, 1, 1)), '^[A-Z]$')
            THEN upper(substr(p_name, 1, 1)) ELSE '0' END AS letter, sum(p_size) AS b FROM part GROUP BY ALL))))"""


def parts_by_brand(spark, d):
    return table(spark, d, "part").select(
        F.lit("src").alias("source"), F.lit("8k").alias("tier"), F.col("p_brand").alias("category"),
        F.concat_ws("#", "p_name", "p_partkey").alias("id"), F.col("p_size").cast("long").alias("length"),
    )


@query("letter_ranges", LETTERS_SQL)
def letter_ranges(spark, d):
    return C.letter_ranges(parts_by_brand(spark, d), max_bytes=LETTER_LIMIT).select("category", "letter", "letters")


@query(
    "letter_bundles",
    f"""
    SELECT file, source, tier, category, letters, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS bytes
    FROM (SELECT p_size, 'src' AS source, '8k' AS tier, category, letters,
        'assetlake-src-8k-' || category || coalesce('-' || letters, '') || '.parquet' AS file
      FROM part JOIN ({LETTERS_SQL}) r ON category = p_brand AND letter =
        CASE WHEN regexp_matches(upper(substr(p_name, 1, 1)), '^[A-Z]$') THEN upper(substr(p_name, 1, 1)) ELSE '0' END)
    GROUP BY ALL""",
)
def letter_bundles(spark, d):
    """Bundles of a high tier, one per range of first letters; their names are parsed back."""
    sizes = C.split_by_letters(parts_by_brand(spark, d), max_bytes=LETTER_LIMIT)
    chunks = sizes.withColumns({"chunk": F.lit(1), "numbered": F.lit(False)})
    files = C.bundle_files(C.chunk_bounds(chunks))
    brands = [f"Brand#{i}" for i in range(100)]
    parsed = parse_asset_name("parquet_file", categories=brands)
    return files.select(F.col("parquet_file").alias("file"), parsed.alias("p"), "n", "bytes").select(
        "file", "p.source", "p.tier", "p.category", "p.letters", "n", "bytes"
    )


@query(
    "payload_offsets",
    'SELECT parquet_file, id, channel, "offset", length FROM rowmap',
    "rowmap",
)
def payload_offsets(spark, d):
    return rowmap(spark, d).select("parquet_file", "id", "channel", "offset", "length")
