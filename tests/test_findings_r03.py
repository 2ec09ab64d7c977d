"""Faults that larger tables showed in the queries."""

from __future__ import annotations

import hashlib
import re
import zipfile
from datetime import datetime

import __spark_entry__ as entry
import numpy as np
import pyarrow as pa
from assetlake.llm import quality_classifier as C
from assetlake.llm import toxicity as X
from assetlake.plans.bake import archive_textures
from assetlake.sinks.bundles import write_tasks
from assetlake.sources import bundles as B
from assetlake.sources import listings as L
from assetlake.sources import pages as G
from assetlake.streaming import jobs as J
from pyspark.sql import functions as F


def test_fmt_size_beyond_a_long(spark, tmp_path):
    day = datetime(2026, 1, 1)
    rows = [(999, 900_000, "P", 1.0, day, "1"), (3, 20, "P", 1.0, day, "1"), (None, 20, "F", 1.0, day, "1")]
    spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    out = entry.queries()["fmt_size"](spark, str(tmp_path))
    got = {r["o_orderkey"]: (r["n"], r["size"]) for r in out.collect()}
    n = 900_000**2 * 999 * 60_000
    assert n >= 2**63
    assert got == {999: (None, f"{n / 2**50:.1f} PB"), 3: (72_000_000, "68.7 MB"), None: (None, None)}


def test_small_chunks_of_a_rotating_sink_share_files(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "source string, tier string, category string, id string, length bigint"
    want = {}
    for b in range(2):
        rows = [("s", "1k", c, f"{b}{i:03d}", 10) for c in ("metal", "wood") for i in range(150)]
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(landing)
        stream = J.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        J.rotating_sink(stream, out, mark, 25).awaitTermination()
        want |= {(c, f"{b}{i:03d}"): (150 * b + i) // 3 + 1 for c in ("metal", "wood") for i in range(150)}
    got = spark.read.parquet(f"{out}/rows")
    assert {(r["category"], r["id"]): r["chunk"] for r in got.collect()} == want
    assert len(got.inputFiles()) <= 2 * (4 + 2)  # before: a file per chunk and task


def test_open_chunk_that_shares_its_file_is_found_again(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "source string, tier string, category string, id string, length bigint"

    def push(rows):
        spark.createDataFrame([("s", "1k", "metal", i, n) for i, n in rows], schema).coalesce(1).write.mode(
            "append"
        ).parquet(landing)
        stream = J.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        J.rotating_sink(stream, out, mark, 20).awaitTermination()

    push([("a", 10), ("b", 10), ("c", 10)])  # a and b fill chunk 1, c opens chunk 2
    push([("c", 1), ("a", 1), ("d", 30)])  # c goes to its open chunk, a to the one that is open now
    got = {(r["id"], r["length"], r["chunk"]) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {("a", 10, 1), ("b", 10, 1), ("c", 10, 2), ("c", 1, 2), ("a", 1, 2), ("d", 30, 2)}


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """Two fits differ by one label: with all rows in the fit, whichever it is, so do their models."""
    rng = np.random.default_rng(1)
    words = ["good", "word", "of", "the", "house", "is", "fine", "tree"]
    docs = [(i, " ".join(rng.choice(words, 3 + i % 17)) + "!" * int(rng.integers(0, 4))) for i in range(80)]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    marks = [(i, int(rng.integers(0, 2))) for i, _ in docs]
    seen = []
    told = C.differences
    monkeypatch.setattr(C, "RANKED_ROWS", 10)  # numbered in ranges

    def noted(ranked, counts, pairs):
        out = told(ranked, counts, pairs)
        seen.append((ranked.count(), dict(counts), out.count(), ranked.select("y", "no").distinct().count()))
        return out

    monkeypatch.setattr(C, "differences", noted)
    model = C.train(texts, spark.createDataFrame(marks, "doc_id long, quality int"))
    free = texts.where(~C.held_out(texts.doc_id)).count()
    (n, counts, pairs, numbers), = seen
    assert n == numbers == free == sum(counts.values())
    assert pairs == 8 * min(counts.values()) + max(counts.values())
    x = C.features(texts.where(~C.held_out(texts.doc_id)), "text", "x").select("x").collect()
    scores = np.sort(np.array([r["x"] for r in x]) @ np.array(model.weights))
    assert np.isclose(model.threshold, (scores[counts[0] - 1] + scores[counts[0]]) / 2)


def test_many_pages_and_small_bundles_are_few_tasks(spark):
    pages = [G.Page(i, f"{i}.json") for i in range(10_000)]
    runs = G.in_runs(pages)
    assert [p for r in runs for p in r.pages] == pages and len(runs) == 157
    assert len(G.in_runs(pages[:40])) == 40 and G.in_runs([]) == []
    assert write_tasks(spark, 50_000, 50_000 * 1000) == 4  # before: a task each
    assert write_tasks(spark, 3, 10**12) == 3 and write_tasks(spark, 1000, 10**11) == 746


def test_quality_shuffles_features_not_texts(spark, monkeypatch):
    docs = [(i, "fine words of the house " * (i % 5) + "!" * (i % 3)) for i in range(60)] + [(None, "x"), (3, "again"), (5, None)]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id long, quality int")
    plans, frozen = [], C.freeze

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return frozen(df, name)

    monkeypatch.setattr(C, "freeze", noted)
    got = C.digest(texts, marks)
    kept = C.keep_good(texts, marks)
    assert got.count() == 63 and kept.columns == texts.columns and kept.count() == got.where("predicted = 1").count()
    joins = [p for p in plans if "Join" in p]
    assert joins and not any("text" in p for p in joins)  # before: texts and labels met in a shuffle


def test_small_files_are_listed_and_read_by_a_fixed_number_of_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"a{i}.json").write_text('{"Diffuse": {"1k": {"png": {"url": "u%d"}}}}' % i)
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.json").write_text('{"Diffuse": {"1k": {"png": {"url": "no"}}}}')
    tree = L.read_asset_files(spark, str(tmp_path))
    assert {(r["slug"], r["tier"]) for r in tree.collect()} == {(f"a{i}", "1k") for i in range(200)}
    for df in (tree, B.list_files(spark, str(tmp_path)), B.read_documents(spark, str(tmp_path))):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()  # before: files listed on the driver
        assert df.rdd.getNumPartitions() <= 2 * 4 + 8
    assert B.list_files(spark, str(tmp_path)).count() == 201 and B.list_files(spark, f"{tmp_path}/a1*.json").count() == 111


def test_archives_are_read_by_all_tasks_however_small_their_rows(spark, tmp_path):
    for i in range(40):
        with zipfile.ZipFile(tmp_path / f"m{i}.zip", "w") as zf:
            zf.writestr("T_1K_Color.png", b"\x89PNG%d" % i)
    got = archive_textures(spark, str(tmp_path), "ambientcg").withColumn("task", F.spark_partition_id()).collect()
    assert {(r["id"], bytes(r["payload"])) for r in got} == {(f"m{i}", b"\x89PNG%d" % i) for i in range(40)}
    assert len({r["task"] for r in got}) == 4  # before: one


def test_queries_bound_the_batches_of_python_tasks(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    entry.queries()["transcode_tier"](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 8 << 20


def test_rare_grams_have_estimates_of_their_own(spark, monkeypatch):
    words = [f"w{i:03x}" for i in range(300)]
    # far below 2^-20 of either class, and in no frequent context
    rows = [(0, " ".join(words * 12000)), (1, " ".join(words * 3000)), (1, "qzqzqz qzqzqz"), (0, "xjxjxj"), (1, None)]
    rows = spark.createDataFrame(rows, "toxic long, text string")
    counted = X.class_words(rows)
    counts = X.class_counts(rows).localCheckpoint()
    total = counts.agg(F.sum("t"), F.sum("o")).first()
    grams, _ = X.grams_of(pa.array(["qzqzqz"]))
    assert max(total) * 2**-20 > 2 and len(np.unique(grams)) == 7
    n = {r.gram & (1 << 64) - 1: (r.t, r.o) for r in counts.collect()}
    assert n[int(grams[-1])] == (2, 0)
    # estimates made in tasks are those of all grams at once
    known = np.array(sorted(n), np.uint64)
    want, contexts, other, _ = X.estimate(known, np.array([n[int(g)] for g in known], float).T)
    want = dict(zip(known.tolist(), want.tolist(), strict=True))
    others = dict(zip(contexts.tolist(), other.tolist(), strict=True))
    values = X.estimates(counts).localCheckpoint()
    got = {(r.context << 8) | k: v for r in values.collect() for k, v in r.ratios.items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert all(abs(r.other - others[r.context]) < 1e-9 for r in values.collect())

    # the ratio of a text is the same whether its words and contexts are in the tasks or joined
    texts = ["", "qzqzqz w001 qzqzqz, xjxjxj", "qzqzab", "w001 w002", "qzqzqz", "qzqzqz", "日本"]

    def plain(text):
        total = []
        for w in re.findall(r"[0-9a-z\x80-\uffff]+", text):
            g = X.grams_of(pa.array([w]))[0].tolist()
            x = sum(want.get(k, others.get(k >> 8, 0.0)) for k in g)
            total.append(np.log1p(X.RATE * np.expm1(x)))
        return float(np.mean(total)) if total else 0.0

    keyed = spark.createDataFrame([(t,) for t in texts], "text string").select(X.key_of(F.col("text")).alias("key"), "text")
    for most_grams, most in ((1 << 20, 1 << 20), (40, 1 << 20), (40, 2), (0, 0)):
        monkeypatch.setattr(X, "HOT", most_grams)
        monkeypatch.setattr(X, "KNOWN", most)
        model = X.known_words(counted, X.hot(values))
        assert len(model.words) <= most and len(model.grams) <= most_grams
        assert model.values.isEmpty() == (most_grams > 40)
        out = X.mean_ratios(keyed, model).collect()
        ratio = {bytes(r.key): r.ratio for r in out}
        assert len(out) == len(set(texts))
        for t in texts:
            assert abs(ratio[hashlib.md5(t.encode()).digest()] - plain(t)) < 1e-9
    assert plain("qzqzqz") > plain("xjxjxj") and plain("qzqzqz") != plain("")
