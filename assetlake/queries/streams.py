"""Streaming queries: the final state of a stream over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import payload as B
from assetlake.operators import select as P
from assetlake.queries.ranges import FRAMED, FRAMED_SHA, png_tex
from assetlake.queries.registry import (
    CATEGORY_OF_NO,
    CHANNEL_OF_NO,
    SOURCE_OF_NO,
    log,
    pick,
    query,
    snapshots,
    sql_pick,
    table,
)
from assetlake.session import run_dir
from assetlake.sources.bundles import fetch_ranges
from assetlake.streaming import jobs as J
from assetlake.streaming import watch as W
from assetlake.streaming.dedupe import dedupe_to_table

LANGS = ["de", "en", "es", "fr"]


def hashed(rows):
    """Baking step of the streams: material key, channel, hash and length of every document."""
    m = F.floor(F.col("doc_id") / 4)
    data = F.encode("text", "UTF-8")
    return rows.select(
        pick(SOURCE_OF_NO, m).alias("source"),
        m.cast("string").alias("id"),
        F.lit("1k").alias("tier"),
        pick(CHANNEL_OF_NO, F.col("doc_id")).alias("channel"),
        B.sha256(data).alias("sha256"),
        B.size(data).alias("length"),
    )


@query("bake_stream", "SELECT source, id, tier, channel, sha256, length FROM tex", "tex")
def bake_stream(spark, d):
    """All documents in bounded batches of files."""
    docs = table(spark, d, "documents")
    landing, out, mark = (run_dir(spark, n) for n in ("landing", "baked", "mark"))
    docs.repartition(6).write.parquet(landing)
    stream = J.file_stream(spark, landing, docs.schema, max_files=2)
    J.bake_stream(stream, hashed, out, mark).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def resumed(spark, d) -> str:
    """One stream in three runs over what has landed by then; the second run finds nothing new."""
    docs = table(spark, d, "documents")
    landing, out, mark = (run_dir(spark, n) for n in ("landing", "baked", "mark"))
    early = F.col("lang").isin(LANGS[:2])
    docs.filter(early).write.parquet(landing)
    for more in (None, None, docs.filter(~early)):
        if more is not None:
            more.write.mode("append").parquet(landing)
        stream = J.file_stream(spark, landing, docs.schema, max_files=100)
        J.bake_stream(stream, hashed, out, mark).awaitTermination()
    return out


@query("resume_stream", "SELECT source, id, tier, channel, sha256, length FROM tex", "tex")
def resume_stream(spark, d):
    return spark.read.parquet(resumed(spark, d)).drop("batch")


@query(
    "progress",
    "SELECT source, tier, CAST(2 AS BIGINT) AS batches, count(*) AS offset_done FROM tex GROUP BY source, tier",
    "tex",
)
def progress(spark, d):
    return J.progress(spark, resumed(spark, d))


def sightings(spark, d):
    """(source, id, snapshot, digest) of two listings: one digest per material and snapshot."""
    rows = []
    for no, snap in enumerate(snapshots(spark, d), start=1):
        parts = F.array_sort(F.collect_list(F.concat_ws(":", "channel", "sha256")))
        rows.append(
            snap.groupBy("source", "id").agg(F.md5(F.array_join(parts, ",")).alias("digest"))
            .withColumn("snapshot", F.lit(no).cast("long"))
        )
    return rows[0].unionByName(rows[1]).select("source", "id", "snapshot", "digest")


SIGHTINGS_SQL = " UNION ALL ".join(
    f"""SELECT source, id, CAST({no} AS BIGINT) AS snapshot,
      md5(string_agg(channel || ':' || sha256, ',' ORDER BY channel || ':' || sha256)) AS digest
    FROM {view} GROUP BY source, id"""
    for no, view in ((1, "snap_old"), (2, "snap_new"))
)


# Four listings a day apart: materials come and go, their digests change, one source is silent for two.
LISTINGS_SQL = f"""
  SELECT source, id, k AS snapshot, TIMESTAMP '2026-04-18' + k * INTERVAL 1 DAY AS ts,
    md5(digest || ((CAST(id AS BIGINT) % 7 + k) // 3)) AS digest
  FROM ({SIGHTINGS_SQL}), (SELECT unnest([1, 2, 3, 4])::BIGINT AS k)
  WHERE snapshot = 1 AND (k IN (1, 4) OR source <> 'gpuopen') AND (CAST(id AS BIGINT) + k) % 5 <> 0"""


def listings(spark, d):
    first = sightings(spark, d).filter("snapshot = 1").drop("snapshot")
    n = F.col("id").cast("long")
    rows = first.withColumn("snapshot", F.explode(F.sequence(F.lit(1), F.lit(4)))).filter(
        (F.col("snapshot").isin(1, 4) | (F.col("source") != "gpuopen")) & ((n + F.col("snapshot")) % 5 != 0)
    )
    turn = F.floor((n % 7 + F.col("snapshot")) / 3).cast("string")
    return rows.select(
        "source", "id", F.col("snapshot").cast("long").alias("snapshot"),
        F.timestamp_add("DAY", "snapshot", F.lit("2026-04-18").cast("timestamp")).alias("ts"),
        F.md5(F.concat("digest", turn)).alias("digest"),
    )


def landed_one_by_one(spark, rows, stream, out):
    """Results of ``stream`` over the listings, each of which lands after the one before is done."""
    landing, mark = run_dir(spark, "landing"), run_dir(spark, "mark")
    for no in range(1, 5):
        rows.filter(F.col("snapshot") == no).write.mode("append").parquet(landing)
        listing = J.file_stream(spark, landing, rows.schema, max_files=1000)
        J.to_table(stream(listing), out, mark).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(
    "watch_stream",
    f"""
    SELECT source, id, snapshot, digest, CASE WHEN last IS NULL OR ts - seen > INTERVAL 60 HOUR THEN 'new'
      WHEN last = digest THEN 'unchanged' ELSE 'changed' END AS change
    FROM (SELECT *, lag(digest) OVER w AS last, lag(ts) OVER w AS seen
      FROM ({LISTINGS_SQL}) WINDOW w AS (PARTITION BY source, id ORDER BY snapshot))""",
    "diff",
)
def watch_stream(spark, d):
    """Four batches; what was not met for 60 hours is forgotten, so a source that was silent is new again."""
    return landed_one_by_one(spark, listings(spark, d), lambda s: W.watch_stream(s, 60 * 3600 * 1000), run_dir(spark, "watch"))


@query(
    "source_status",
    f"""
    SELECT source, unnest(CASE WHEN last IS NULL THEN ['up'] ELSE ['down', 'up'] END) AS status,
      strftime(unnest(CASE WHEN last IS NULL THEN [ts] ELSE [last + INTERVAL 36 HOUR, ts] END), '%Y-%m-%d %H:%M:%S') AS at
    FROM (SELECT source, ts, lag(ts) OVER (PARTITION BY source ORDER BY ts) AS last
      FROM (SELECT DISTINCT source, ts FROM ({LISTINGS_SQL})))
    WHERE last IS NULL OR ts - last > INTERVAL 36 HOUR""",
    "diff",
)
def source_status(spark, d):
    """One source is silent for two of four listings: a timer reports it as down, and it comes back."""
    out = landed_one_by_one(spark, listings(spark, d), lambda s: W.source_status(s, 36 * 3600 * 1000), run_dir(spark, "status"))
    return out.select("source", "status", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "removed_materials",
    "SELECT source, id, CAST(1 AS BIGINT) AS last_seen FROM diff WHERE change = 'removed' AND source <> 'gpuopen'",
    "diff",
)
def removed_materials(spark, d):
    """The second listing of one source was never completed, so it removes nothing."""
    rows = sightings(spark, d)
    done = rows.select("source", "snapshot").distinct()
    complete = done.filter("NOT (source = 'gpuopen' AND snapshot = 2)")
    return W.removed_materials(rows, complete)


WINDOW_SQL = """
  SELECT {start} AS window_start, count(*) FILTER (WHERE ok) AS ok,
    count(*) FILTER (WHERE NOT ok) AS failed, CAST(sum(bytes) AS BIGINT) AS bytes
  FROM {rows} GROUP BY 1"""


def windowed(spark, d, window):
    events = table(spark, d, "events")
    landing = run_dir(spark, "landing")
    # many files in no time order, a few per batch
    events.repartition(12, "event_id").write.parquet(landing)
    stream = J.file_stream(spark, landing, events.schema, max_files=4)
    rows = stream.select(
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") != "error").alias("ok"),
        F.rint(F.col("value") * 100).cast("long").alias("bytes"),
    )
    out, mark = run_dir(spark, "rate"), run_dir(spark, "mark")
    J.rates_to_table(rows, window, out, mark).awaitTermination()
    state = J.merged_rates(spark, out)
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    return state.select(start.alias("window_start"), "ok", "failed", "bytes")


@query(
    "rate_window",
    WINDOW_SQL.format(start="strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S')", rows="log"),
    "log",
)
def rate_window(spark, d):
    return windowed(spark, d, F.window("ts", "1 hour"))


@query(
    "rate_window_sliding",
    WINDOW_SQL.format(
        start="strftime(w, '%Y-%m-%d %H:%M:%S')",
        rows="""(SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS w
          FROM log, (VALUES (0), (1), (2), (3)) v(k))""",
    ),
    "log",
)
def rate_window_sliding(spark, d):
    return windowed(spark, d, F.window("ts", "2 hours", "30 minutes"))


@query(
    "rate_window_session",
    """
    SELECT id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (WHERE ok) AS ok,
      count(*) FILTER (WHERE NOT ok) AS failed, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= INTERVAL 6 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY ts, event_id) AS s
      FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY id ORDER BY ts, event_id) AS gap FROM log))
    GROUP BY id, s""",
    "log",
)
def rate_window_session(spark, d):
    out = J.rate_window(log(spark, d), F.session_window("ts", "6 hours"), ("id",), delay=None)
    start = F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")
    return out.select("id", start.alias("window_start"), "ok", "failed", "bytes")


@query(
    "dedupe_stream",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def dedupe_stream(spark, d):
    """Every event is delivered three times in three batches; no batch knows when the others came."""
    events = table(spark, d, "events")
    landing, out, mark = (run_dir(spark, n) for n in ("landing", "dedupe", "mark"))
    for part in (F.col("event_id") % 3 > 0, F.lit(True), F.col("event_id") % 2 == 0):
        for _ in range(2):
            events.filter(part).write.mode("append").parquet(landing)
        stream = J.file_stream(spark, landing, events.schema, max_files=1000)
        dedupe_to_table(stream, ["event_id"], out, mark).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("event_id", "user_id", "event_type", "value")


@query(
    "stream_bundles",
    f"""SELECT source, tier, category, id, channel, {FRAMED} AS length, {FRAMED_SHA} AS sha256,
          NULL::VARCHAR AS error_kind FROM tex WHERE channel <> 'ao' OR length % 2 = 0""",
    "tex",
)
def stream_bundles(spark, d):
    """Bake a stream: odd occlusion maps are no images and drop, the others go into rotating bundles.

    Materials come in three batches; the bundles of closed and of open chunks are read back by their
    rowmaps and every range is hashed.
    """
    out, mark, landing = (run_dir(spark, n) for n in ("rotated", "mark", "landing"))
    framed = png_tex(spark, d).withColumn("third", F.pmod(F.col("id").cast("long"), F.lit(3)))
    odd = (F.col("channel") == "ao") & (F.pmod(F.length("payload") - 12, F.lit(2)) == 1)
    payload = F.when(odd, F.encode(F.lit("no image"), "UTF-8")).otherwise(F.col("payload"))
    rows = framed.withColumn("payload", payload).drop("length", "sha256")
    seal = J.Seal("2026-04-18T00:00:00+00:00")
    for third in range(3):
        part = rows.filter(F.col("third") == third).drop("third")
        part.write.mode("append").parquet(landing)
        stream = J.file_stream(spark, landing, part.schema, max_files=1000)
        good = P.hashed_textures(stream).filter("valid").drop("valid")
        J.rotating_sink(good, out, mark, 100_000, seal=seal).awaitTermination()
    J.seal_open(spark, out, seal)
    rowmap, files = J.sealed(spark, out)
    got = fetch_ranges(rowmap, rowmap, files)
    cells = rowmap.select("source", "tier", "id", "category").distinct()
    return got.join(cells, ["source", "tier", "id"]).select(
        "source", "tier", "category", "id", "channel", "length",
        B.sha256("payload").alias("sha256"), "error_kind",
    )


@query(
    "rotating_sink",
    f"""
    WITH RECURSIVE rows_ AS (
      SELECT {sql_pick(SOURCE_OF_NO, "(doc_id // 40)")} AS source, {sql_pick(CATEGORY_OF_NO, "(doc_id // 40)")} AS category,
        CAST(doc_id AS VARCHAR) AS id, lang, octet_length(encode(text)) AS length,
        CASE WHEN lang IN ('de', 'en') THEN 0 ELSE 1 END AS batch FROM documents),
    pos AS (SELECT *, row_number() OVER (PARTITION BY source, category ORDER BY batch, id) AS rn FROM rows_),
    walk AS (
      SELECT source, category, id, length, rn, 1 AS chunk, length AS used FROM pos WHERE rn = 1
      UNION ALL
      SELECT p.source, p.category, p.id, p.length, p.rn, w.chunk + CASE WHEN w.used >= 30000 THEN 1 ELSE 0 END,
        CASE WHEN w.used >= 30000 THEN 0 ELSE w.used END + p.length
      FROM walk w JOIN pos p ON p.source = w.source AND p.category = w.category AND p.rn = w.rn + 1)
    SELECT source, category, id, length, chunk FROM walk""",
)
def rotating_sink(spark, d):
    """Two batches into the same open chunks: first two languages, then the other two."""
    docs = table(spark, d, "documents")
    m = F.floor(F.col("doc_id") / 40)
    rows = docs.select(
        pick(SOURCE_OF_NO, m).alias("source"), F.lit("1k").alias("tier"),
        pick(CATEGORY_OF_NO, m).alias("category"), F.col("doc_id").cast("string").alias("id"),
        F.octet_length(F.encode("text", "UTF-8")).cast("long").alias("length"),
        F.col("lang").isin(LANGS[:2]).alias("early"),
    )
    landing, out, mark = (run_dir(spark, n) for n in ("landing", "rotated", "mark"))
    for early in (True, False):
        rows.filter(F.col("early") == early).write.mode("append").parquet(landing)
        stream = J.file_stream(spark, landing, rows.schema, max_files=1000)
        J.rotating_sink(stream, out, mark, 30_000).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("source", "category", "id", "length", "chunk")


