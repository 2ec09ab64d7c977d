import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetlake.streaming import dedupe as D
from assetlake.streaming import jobs as J
from assetlake.streaming import watch as W
from tests.test_chunking import greedy

SCHEMA = "source string, tier string, category string, id string, length bigint"


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema, max_files=1):
    return J.file_stream(spark, path, schema, max_files=max_files)


def test_bake_stream_equals_batch_and_a_restart_adds_nothing(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(3):
        land(spark, [("s", "1k", "metal", f"{i}{j}", 5) for j in range(4)], SCHEMA, landing)

    def double(df):
        return df.withColumn("length", F.col("length") * 2)

    for _ in range(2):
        J.bake_stream(stream(spark, landing, SCHEMA), double, out, mark).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 12 and rows.agg(F.sum("length")).first()[0] == 120
    marker = J.progress(spark, out)
    assert [tuple(r) for r in marker.collect()] == [("s", "1k", 3, 12)]
    assert J.resume_offset(marker, "s", "1k") == 12 and J.resume_offset(marker, "s", "2k") == 0


def test_failed_batch_is_repeated_without_duplicates(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(2):
        land(spark, [("s", "1k", "metal", str(i), 5)], SCHEMA, landing)
    calls = []

    def flaky(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return df

    with pytest.raises(Exception):
        J.bake_stream(stream(spark, landing, SCHEMA), flaky, out, mark).awaitTermination()
    J.bake_stream(stream(spark, landing, SCHEMA), flaky, out, mark).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["0", "1"]


def test_rotating_sink_goes_on_over_batches(spark, tmp_path):
    rnd = random.Random(3)
    rows = [("s", "1k", rnd.choice(["metal", "other"]), f"{b}{i:03d}", rnd.randint(1, 30))
            for b in range(3) for i in range(20)]
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for b in range(3):
        land(spark, [r for r in rows if r[3][0] == str(b)], SCHEMA, landing)
    J.rotating_sink(stream(spark, landing, SCHEMA), out, mark, 100).awaitTermination()
    got = {r["id"]: r["chunk"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == greedy(rows, 100)


def test_rotating_sink_seals_its_chunks(spark, tmp_path):
    from assetlake import schemas as S
    from assetlake.sources.bundles import fetch_ranges

    schema = "source string, tier string, category string, id string, channel string, payload binary, length bigint"
    rnd = random.Random(5)
    want, landing, out, mark = {}, *(str(tmp_path / n) for n in ("in", "out", "mark"))
    seal = J.Seal("2026-04-18T00:00:00+00:00")
    for b in range(3):
        rows = []
        for i in range(8):
            for channel in ("color", "normal"):
                payload = S.PNG_MAGIC + rnd.randbytes(rnd.randint(1, 60))
                # ids of a later batch lie between those of the earlier ones
                rows.append(("s", "1k", "metal", f"{i}{b}", channel, payload, len(payload)))
                want[f"{i}{b}", channel] = payload
        land(spark, rows, schema, landing)
        J.rotating_sink(stream(spark, landing, schema), out, mark, 300, seal=seal).awaitTermination()
        rowmap, files = J.sealed(spark, out)
        closed = rowmap.count()
        J.seal_open(spark, out, seal)  # replaced by the next batch
        rowmap, files = J.sealed(spark, out)
        got = {(r["id"], r["channel"]): bytes(r["payload"]) for r in fetch_ranges(rowmap, rowmap, files).collect()}
        assert got == want and closed < len(want)
    assert files.count() > 3


def test_a_close_reads_its_chunk_only(spark, tmp_path, monkeypatch):
    from assetlake import schemas as S
    from assetlake.sources.bundles import fetch_ranges

    schema = "source string, tier string, category string, id string, channel string, payload binary, length bigint"
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    seal, reads, want = J.Seal("2026-04-18T00:00:00+00:00"), [], {}
    read = J.chunk_rows

    def noted(*args):
        df = read(*args)
        reads.append(df)
        return df

    monkeypatch.setattr(J, "chunk_rows", noted)

    def push(category, ids, channel, size):
        rows = []
        for i in ids:
            payload = S.PNG_MAGIC + bytes([len(want) % 256]) * size
            rows.append(("s", "1k", category, i, channel, payload, len(payload)))
            want[i, channel] = payload
        land(spark, rows, schema, landing)
        reads.clear()
        J.rotating_sink(stream(spark, landing, schema), out, mark, 400, seal=seal).awaitTermination()

    push("metal", ["a", "b"], "color", 90)  # 198 bytes, stays open
    push("other", ["big0", "big1"], "color", 150)  # 318 bytes of another group, open too
    push("metal", ["b", "c"], "normal", 20)  # b is met again while its chunk is open
    push("metal", ["d"], "color", 200)  # fills the chunk of metal
    files = [f for df in reads for f in df.inputFiles()]
    assert files and all("category=metal" in f for f in files)
    assert sum(r["length"] for r in reads[-1].collect()) == sum(len(v) for (i, _), v in want.items() if "big" not in i)
    rows = spark.read.parquet(f"{out}/rows")
    assert {(r["id"], r["chunk"]) for r in rows.collect()} == {(i, 1) for i, _ in want}
    push("metal", ["b"], "ao", 30)  # its chunk is closed: a further row in the open one
    assert {r["chunk"] for r in spark.read.parquet(f"{out}/rows").filter("id = 'b'").collect()} == {1, 2}
    J.seal_open(spark, out, seal)
    rowmap, files = J.sealed(spark, out)
    got = {(r["id"], r["channel"]): bytes(r["payload"]) for r in fetch_ranges(rowmap, rowmap, files).collect()}
    assert got == want


def test_rotating_sink_needs_the_state_before(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for b in range(2):
        land(spark, [("s", "1k", "metal", f"{b}", 5)], SCHEMA, landing)
        place = out if b == 0 else str(tmp_path / "elsewhere")
        query = J.rotating_sink(stream(spark, landing, SCHEMA), place, mark, 100)
        if b == 0:
            query.awaitTermination()
        else:
            with pytest.raises(Exception, match="is missing"):
                query.awaitTermination()


WATCHED = "source string, id string, snapshot bigint, digest string, ts timestamp"


def days(no):
    return (pd.Timestamp("2026-04-18") + pd.Timedelta(days=no)).to_pydatetime()


def test_watch_stream_and_removal(spark, tmp_path):
    schema = WATCHED
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    one, two, three = map(days, (1, 2, 3))
    land(spark, [("s", "a", 1, "x", one), ("s", "b", 1, "x", one), ("t", "c", 1, "x", one)], schema, landing)
    land(spark, [("s", "a", 2, "y", two), ("s", "n", 2, "x", two)], schema, landing)
    land(spark, [("s", "a", 3, "y", three)], schema, landing)
    J.to_table(W.watch_stream(stream(spark, landing, schema)), out, mark).awaitTermination()
    rows = spark.read.parquet(out)
    got = {(r["id"], r["snapshot"]): r["change"] for r in rows.collect()}
    assert got == {("a", 1): "new", ("b", 1): "new", ("c", 1): "new", ("a", 2): "changed",
                   ("n", 2): "new", ("a", 3): "unchanged"}
    done = spark.createDataFrame([("s", 1), ("s", 2), ("t", 1)], "source string, snapshot bigint")
    assert [r["id"] for r in W.removed_materials(rows, done).collect()] == ["b"]


def test_rate_window_counts_late_rows(spark, tmp_path):
    schema = "ts timestamp, ok boolean, bytes bigint"
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def t(text):
        return pd.Timestamp(f"2026-04-18 {text}").to_pydatetime()

    land(spark, [(t("10:01:00"), True, 1), (t("10:09:00"), False, 2)], schema, landing)
    land(spark, [(t("10:03:00"), True, 4)], schema, landing)  # late, within the delay
    rate = J.rate_window(stream(spark, landing, schema), F.window("ts", "5 minutes"))
    J.to_table(rate, out, mark, "update").awaitTermination()
    got = {r["window"]["start"].minute: (r["ok"], r["failed"], r["bytes"])
           for r in J.latest_state(spark, out, ["window"]).collect()}
    assert got == {0: (2, 0, 5), 5: (0, 1, 2)}


def test_dedupe_stream(spark, tmp_path):
    schema = "ts timestamp, id string"
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = [(pd.Timestamp("2026-04-18").to_pydatetime(), x) for x in "aab"]
    for _ in range(2):
        land(spark, rows, schema, landing)
    J.to_table(J.dedupe_stream(stream(spark, landing, schema), ["id"]), out, mark).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_rates_of_many_files_in_no_order_lose_nothing(spark, tmp_path):
    schema = "ts timestamp, ok boolean, bytes bigint"
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    start = pd.Timestamp("2026-04-18")
    rows = [((start + pd.Timedelta(minutes=37 * i % 4000)).to_pydatetime(), i % 5 > 0, i) for i in range(400)]
    for k in range(8):
        land(spark, rows[k::8], schema, landing)
    log = stream(spark, landing, schema)
    J.rates_to_table(log, F.window("ts", "1 hour"), out, mark).awaitTermination()
    got = J.merged_rates(spark, out).agg(F.sum("ok"), F.sum("failed"), F.sum("bytes")).first()
    assert tuple(got) == (320, 80, sum(range(400)))


def test_late_snapshots_change_nothing(spark, tmp_path):
    schema = WATCHED
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for no, digest in ((2, "new"), (1, "old"), (3, "new")):
        land(spark, [("s", "a", no, digest, days(no))], schema, landing)
        listing = stream(spark, landing, schema)
        J.to_table(W.watch_stream(listing), out, mark).awaitTermination()
    got = {r["snapshot"]: r["change"] for r in spark.read.parquet(out).collect()}
    assert got == {2: "new", 1: "late", 3: "unchanged"}


def test_state_of_a_material_expires(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    day = 24 * 3600 * 1000
    #  b is met on days 1 and 9, its state is dropped when a has moved on; c returns within the time kept
    for no, ids in ((1, "abc"), (2, "a"), (3, "ac"), (9, "ab")):
        land(spark, [("s", i, no, "x", days(no)) for i in ids], WATCHED, landing)
        J.to_table(W.watch_stream(stream(spark, landing, WATCHED), 2 * day), out, mark).awaitTermination()
    got = {(r["id"], r["snapshot"]): r["change"] for r in spark.read.parquet(out).collect()}
    assert got == {
        ("a", 1): "new", ("b", 1): "new", ("c", 1): "new", ("a", 2): "unchanged",
        ("a", 3): "unchanged", ("c", 3): "unchanged", ("a", 9): "new", ("b", 9): "new",
    }
    state = spark.read.format("statestore").option("stateVarName", "last").load(mark)
    assert {r["key"]["id"] for r in state.collect()} == {"a", "b"}


def test_dedupe_finds_duplicates_of_any_age(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "BUCKETS", 4)
    schema = "k string, j int, v int"
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rnd = random.Random(6)
    sent = set()
    for batch in range(5):
        rows = [(rnd.choice([None, *map(str, range(60))]), rnd.choice([None, 1, 2]), batch) for _ in range(80)]
        land(spark, rows, schema, landing)
        sent |= {(k, j) for k, j, _ in rows}
        D.dedupe_to_table(stream(spark, landing, schema), ["k", "j"], out, mark).awaitTermination()
    got = [(r["k"], r["j"]) for r in spark.read.parquet(f"{out}/rows").collect()]
    assert len(got) == len(set(got)) and set(got) == sent


def test_bloom_filter():
    import numpy as np

    rng = np.random.default_rng(1)
    keys, others = (rng.integers(-(2**63), 2**63 - 1, n) for n in (5000, 40000))
    data = D.make_filter(keys)
    assert D.in_filter(keys, data).all() and D.in_filter(others, data).mean() < 0.002
