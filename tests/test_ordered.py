import json
import os

import pytest
from pyspark.sql import functions as F

from assetlake.operators import rowmap as M
from assetlake.sinks import documents as O
from assetlake.sinks.ordered import ordered_parts, write_ordered
from assetlake.sources.bundles import located_ranges


def tables(spark, pieces, frames):
    return (
        spark.createDataFrame(pieces, "file string, key string, piece string"),
        spark.createDataFrame(frames, "file string, head string, tail string"),
    )


@pytest.mark.parametrize("part_bytes", [1, 7, 64, 10**6])
def test_parts_are_the_document_whatever_their_size(spark, tmp_path, part_bytes):
    keys = [f"k{i:03d}" for i in range(60)]
    texts = {"hot.json": {k: "ü" * (i % 9) for i, k in enumerate(keys)}, "one.json": {"a": "x" * 500}, "none.json": {}}
    pieces, frames = tables(
        spark,
        [(f, k, v) for f, entries in texts.items() for k, v in reversed(entries.items())] + [("lost.json", "a", "x")],
        [(f, "<é ", ">") for f in texts],
    )
    want = {f: "<é " + ", ".join(v for _, v in sorted(e.items())) + ">" for f, e in texts.items()}
    parts = ordered_parts(pieces, frames, part_bytes, ", ")
    joined = {}
    for r in sorted(parts.collect(), key=lambda r: (r["file"], r["start"])):
        assert r["start"] == len(joined.get(r["file"], "").encode())
        joined[r["file"]] = joined.get(r["file"], "") + r["content"]
    assert joined == want
    root = tmp_path / "out"
    assert write_ordered(parts, str(root)) == (3, sum(len(w.encode()) for w in want.values()))
    assert {f: (root / f).read_text() for f in os.listdir(root)} == want  # no part is left
    assert write_ordered(parts, str(root))[0] == 3  # once more, over the finished files
    assert {f: (root / f).read_text() for f in os.listdir(root)} == want


def test_no_part_is_larger_than_its_bound_and_a_piece(spark):
    pieces = spark.range(2000).select(
        F.lit("f").alias("file"), F.format_string("%05d", "id").alias("key"), F.repeat(F.lit("x"), 99).alias("piece")
    )
    frames = spark.createDataFrame([("f", "{", "}")], "file string, head string, tail string")
    sizes = [len(r["content"]) for r in ordered_parts(pieces, frames, 10_000).collect()]
    assert sum(sizes) == 2000 * 100 + 1 and max(sizes) <= 10_101 and len(sizes) == 20


def test_no_documents(spark, tmp_path):
    pieces, frames = tables(spark, [], [])
    assert write_ordered(ordered_parts(pieces, frames), str(tmp_path / "out")) == (0, 0)


def test_maps_beyond_the_limit_of_a_row(spark, tmp_path):
    docs = spark.createDataFrame(
        [("s", f"m{i}", "p", f'<a b="{i}">\n\tö\\</a>') for i in range(50)] + [("s", "none", "p", None)],
        "source string, id string, path string, xml string",
    )
    with pytest.raises(O.DocumentMapTooLarge, match="write_document_maps"):
        O.document_map(docs, 100)
    O.write_document_maps(docs, str(tmp_path / "out"), part_bytes=100)
    text = (tmp_path / "out" / "s-mtlx.json").read_text()
    assert text == O.document_map(docs).first()["content"]
    assert json.loads(text) == {r["id"]: r["xml"] for r in docs.collect()}


def test_rowmaps_beyond_the_limit_of_a_row(spark, tmp_path):
    rows = [("s", "1k", f"m{i}", c, "assetlake-s-1k-wood.parquet", i, 1) for i in range(40) for c in ("ao", "color")]
    long = spark.createDataFrame(
        rows, "source string, tier string, id string, channel string, parquet_file string, offset bigint, length bigint"
    )
    files = spark.createDataFrame(
        [("assetlake-s-1k-wood.parquet", "s", "1k"), ("assetlake-s-1k-other.parquet", "s", "1k")],
        "parquet_file string, source string, tier string",
    )
    with pytest.raises(ValueError, match="write_rowmaps"):
        M.rowmap_documents(long, files, "v2026.04.0", max_materials=39)
    O.write_rowmaps(long, files, "v2026.04.0", str(tmp_path / "out"), part_bytes=200)
    got = {f: (tmp_path / "out" / f).read_text() for f in os.listdir(tmp_path / "out")}
    assert got == {r["file"]: r["content"] for r in M.rowmap_documents(long, files, "v2026.04.0").collect()}


def above(plan, node):
    """Names of the operators above each line of ``plan`` that holds ``node``."""
    path, out = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, x) for d, x in path if d < depth] + [(depth, line.strip())]
        if node in line:
            out.append([x for _, x in path])
    return out


def test_a_bucketed_rowmap_is_not_shuffled(spark, tmp_path):
    long = spark.range(5000).selectExpr(
        "concat('s', id % 3) AS source", "concat(id % 2, 'k') AS tier", "cast(id AS string) AS id",
        "'color' AS channel", "'f' AS parquet_file", "id AS offset", "1L AS length",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = M.write_rowmap_table(long, "rowmap_of_test", 6, str(tmp_path / "table"))
        asked = long.filter("offset % 7 = 0").select("source", "tier", "id", "channel")
        lost = asked.limit(1).withColumn("channel", F.concat(F.col("channel"), F.lit("x")))
        for out in (M.rowmap_entry(asked.union(asked), stored), located_ranges(asked.union(asked), stored)):
            assert sorted(r["offset"] for r in out.collect()) == list(range(0, 5000, 7))
            plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan")[0]
            scans = above(plan, "FileScan parquet")
            assert scans and all("SelectedBucketsCount: 6 out of 6" in s[-1] for s in scans), plan
            assert not any("Exchange" in x for s in scans for x in s), plan
        assert [r["offset"] for r in located_ranges(lost, stored).collect()] == [None]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS rowmap_of_test")
