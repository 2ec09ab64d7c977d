import random

import pytest
from pyspark.sql import functions as F

from assetlake.operators import chunking as C
from assetlake.operators.ordered import running


def sizes_df(spark, seed, n, hot=0.6, top=50):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cat = "other" if rnd.random() < hot else rnd.choice(["metal", "wood"])
        rows.append(("s", "1k", cat, f"m{i:05d}", rnd.randint(1, top)))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(
        rows, "source string, tier string, category string, id string, length bigint"
    )


def greedy(rows, max_bytes, start=None):
    """Brute force: walk each category by id and rotate after the row that reaches the limit."""
    out = {}
    for cat in {r[2] for r in rows}:
        chunk, used = (start or {}).get(cat, (1, 0))
        for r in sorted((r for r in rows if r[2] == cat), key=lambda r: r[3]):
            out[r[3]] = chunk
            used += r[4]
            if used >= max_bytes:
                chunk, used = chunk + 1, 0
    return out


@pytest.mark.parametrize("max_window", [10**6, 7])
def test_running_equals_sorted_loop(spark, max_window):
    rows, df = sizes_df(spark, 1, 300)
    got = running(
        df, ["category"], ["id"], {"before": "length"}, {"peak": "length"}, max_window
    ).collect()
    want = {}
    for cat in {r[2] for r in rows}:
        seq = sorted((r for r in rows if r[2] == cat), key=lambda r: r[3])
        total, peak = 0, None
        for i, r in enumerate(seq, 1):
            want[r[3]] = (i, len(seq), total, sum(x[4] for x in seq), peak)
            total += r[4]
            peak = r[4] if peak is None else max(peak, r[4])
    assert {
        r["id"]: (r["rn"], r["n"], r["before"], r["before_total"], r["peak"]) for r in got
    } == want


def test_running_keeps_rows_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    got = running(df, ["g"], ["v"], {"s": "v"}, max_window_rows=1).collect()
    assert sorted((r["v"], r["rn"], r["s"]) for r in got) == [(1, 1, 0), (2, 2, 1), (3, 1, 0)]


@pytest.mark.parametrize("block, max_bytes", [(10**6, 60), (40, 1), (40, 400), (25, 60), (60, 10**5)])
def test_greedy_rotation_equals_brute_force(spark, block, max_bytes):
    rows, df = sizes_df(spark, block + max_bytes, 250)
    got = C.chunk_by_bytes(df, max_bytes=max_bytes, block_rows=block).collect()
    assert {r["id"]: r["chunk"] for r in got} == greedy(rows, max_bytes)


@pytest.mark.parametrize("block", [10**6, 30])
def test_rotation_goes_on_from_an_open_chunk(spark, block):
    rows, df = sizes_df(spark, 5, 120)
    start = {"other": (4, 70), "metal": (2, 0)}
    carry = spark.createDataFrame(
        [("s", "1k", c, n, b) for c, (n, b) in start.items()],
        "source string, tier string, category string, chunk int, open_bytes bigint",
    )
    got = C.chunk_by_bytes(df, max_bytes=100, block_rows=block, carry=carry).collect()
    assert {r["id"]: r["chunk"] for r in got} == greedy(rows, 100, start)


@pytest.mark.parametrize("window", [10**6, 5])
def test_chunk_by_count(spark, window):
    rows, df = sizes_df(spark, 3, 200)
    got = {r["id"]: r for r in C.chunk_by_count(df, max_bytes=500, max_window_rows=window).collect()}
    for cat in {r[2] for r in rows}:
        ids = sorted(r[3] for r in rows if r[2] == cat)
        total = sum(r[4] for r in rows if r[2] == cat)
        step = max(1, len(ids) // (total // 500 + 1)) if total > 500 else len(ids)
        for i, x in enumerate(ids):
            assert got[x]["chunk"] == i // step + 1
            assert got[x]["numbered"] == (total > 500)


def test_chunk_sizes_stay_below_limit_plus_one_row(spark):
    rows, df = sizes_df(spark, 9, 400)
    chunks = C.chunk_by_bytes(df, max_bytes=300, block_rows=50)
    per = chunks.groupBy(*C.GROUP, "chunk").agg(F.sum("length").alias("b"))
    assert per.agg(F.max("b")).first()[0] < 300 + 50
    assert chunks.count() == len(rows)


def test_alpha_subsplit(spark):
    df = spark.createDataFrame([("alpha",), ("Nut",), ("zinc",), ("9x",)], "id string")
    got = {r["id"]: r["letters"] for r in C.alpha_subsplit(df).collect()}
    assert got == {"alpha": "A-M", "Nut": "N-Z", "zinc": "N-Z", "9x": "0-9"}


def test_payload_offsets(spark):
    df = spark.createDataFrame(
        [("f", "a", 0, 5), ("f", "a", 1, 7), ("f", "b", 0, 1), ("g", "a", 0, 9)],
        "parquet_file string, id string, channel_no int, length bigint",
    )
    got = C.payload_offsets(df).collect()
    assert sorted((r["parquet_file"], r["id"], r["channel_no"], r["offset"]) for r in got) == [
        ("f", "a", 0, 0), ("f", "a", 1, 5), ("f", "b", 0, 12), ("g", "a", 0, 0),
    ]


@pytest.mark.parametrize("window", [10**6, 6])
def test_last_before(spark, window):
    from assetlake.operators.ordered import last_before

    rnd = random.Random(2)
    rows = [(rnd.choice("xxxy"), rnd.randint(0, 60), i) for i in range(120)]
    bounds = [(rnd.choice("xxxz"), rnd.randint(0, 60), f"b{i:02d}") for i in range(30)]
    got = last_before(
        spark.createDataFrame(rows, "g string, at int, i int"), spark.createDataFrame(bounds, "g string, at int, b string"),
        ["g"], "at", ["b"], window,
    )
    want = {i: max(((a, b) for h, a, b in bounds if h == g and a <= at), default=(0, None))[1] for g, at, i in rows}
    assert {r["i"]: r["b"] for r in got.collect()} == want and got.columns == ["g", "at", "i", "b"]


def test_blocks_with_zero_lengths_and_chunks_over_many_blocks(spark):
    rnd = random.Random(4)
    rows = [("s", "1k", "other" if i % 9 else "wood", f"m{i:05d}", rnd.choice([0, 0, 1, 40])) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, tier string, category string, id string, length bigint")
    for block, max_bytes in ((3, 40), (4, 1000), (5, 1)):
        got = C.chunk_by_bytes(df, max_bytes=max_bytes, block_rows=block).collect()
        assert {r["id"]: r["chunk"] for r in got} == greedy(rows, max_bytes)


def test_letter_ranges(spark):
    rnd = random.Random(7)
    rows = [("s", "8k", "metal", f"{rnd.choice('aAbcCdmMnxyzZ9_é')}{i:04d}", rnd.randint(1, 50)) for i in range(300)]
    rows += [("s", "8k", "wood", f"k{i}", 3) for i in range(5)]
    df = spark.createDataFrame(rows, "source string, tier string, category string, id string, length bigint")
    got = C.split_by_letters(df, max_bytes=1500).collect()
    assert len(got) == len(rows) and {r["letters"] for r in got if r["category"] == "wood"} == {None}
    labels = sorted({r["letters"] for r in got if r["category"] == "metal"} - {"0-9"})
    assert labels[0][0] == "A" and labels[-1][2] == "Z"  # no letter is left out
    assert all(ord(b[0]) == ord(a[2]) + 1 for a, b in zip(labels, labels[1:], strict=False))
    total = sum(r[4] for r in rows[:300])
    for r in got[:300]:
        if r["category"] == "metal":
            c = r["id"][0].upper()
            assert r["letters"] == "0-9" if not "A" <= c <= "Z" else r["letters"][0] <= c <= r["letters"][2]
    assert len(labels) > 1 and total > 1500


def test_names_of_letter_bundles_parse_back(spark, tmp_path):
    from assetlake import schemas as S
    from assetlake.functions.names import parse_asset_name, rowmap_name
    from assetlake.sinks import bundles as K

    rows = [("s", "8k", c, f"{x}{i}", "color", S.PNG_MAGIC + bytes(i + 1)) for c in ("metal", "wood") for x in "aZbqB7" for i in range(4 if c == "metal" else 1)]
    df = spark.createDataFrame(rows, "source string, tier string, category string, id string, channel string, payload binary")
    df = df.withColumn("length", F.length("payload").cast("long"))
    meta = df.select("source", "id", F.lit("u").alias("source_url"), F.lit("CC0-1.0").alias("source_license")).distinct()
    path = str(tmp_path / "b")
    chunks, bundles = K.write_partitioned_bundle(df, meta, path, "1", "now", max_bytes=90, letters=True)
    names = {r["parquet_file"] for r in bundles.collect()}
    written = spark.read.parquet(path).select(F.concat("bundle", F.lit(".parquet")).alias("f"), "category", "id")
    parsed = written.select("*", parse_asset_name("f").alias("p"), rowmap_name("f").alias("r"))
    parsed = parsed.select("*", parse_asset_name("r").alias("q")).collect()
    assert len(parsed) == len(rows) and {r["f"] for r in parsed} == names
    for r in parsed:
        letters, c = r["p"]["letters"], r["id"][0].upper()
        assert r["p"]["category"] == r["category"] and r["q"]["letters"] == letters and r["q"]["chunk"] == r["p"]["chunk"]
        if r["category"] == "metal":
            assert letters == "0-9" if c == "7" else letters[0] <= c <= letters[2]
    by_id = K.with_bundle(df, chunks, bundles).select("category", "id", "parquet_file").collect()
    K_rows, K.BROADCAST_ROWS = K.BROADCAST_ROWS, 0
    try:
        assert sorted(K.with_bundle(df, chunks, bundles).select("category", "id", "parquet_file").collect()) == sorted(by_id)
    finally:
        K.BROADCAST_ROWS = K_rows
