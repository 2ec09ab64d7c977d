"""Operators on data of which one key holds more than a third, against plain loops."""

import random

import pytest

from assetlake.operators import lookup as L
from assetlake.operators import quality as Q
from assetlake.operators import releases as R
from assetlake.operators import rowmap as M
from assetlake.operators import select as P

HOT = 0.5


@pytest.fixture()
def skew_settings(spark):
    """Small enough limits for adaptive skew handling to act on test data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hashes(seed, n=600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        h = "hot" if rnd.random() < HOT else f"h{rnd.randint(0, 250)}"
        out.append(("s" if rnd.random() < 0.8 else "t", f"m{i // 3}", ["color", "ao", "normal"][i % 3], h))
    return out


SCHEMA = "source string, id string, channel string, sha256 string"


def test_copies_stay_long(spark, skew_settings):
    rows = hashes(1)
    got = Q.content_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    groups = {}
    for s, i, c, h in set(rows):
        groups.setdefault(h, []).append((s, i, c))
    want = {
        (h, *k): (len(ks), min(ks)) for h, ks in groups.items() if len(ks) > 1 for k in ks
    }
    assert {
        (r["sha256"], r["source"], r["id"], r["channel"]): (r["copies"], tuple(r["first"])) for r in got
    } == want


def test_diff(spark, skew_settings):
    old, new = hashes(2), hashes(3)
    got = R.diff_snapshots(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA))

    def by_id(rows):
        out = {}
        for s, i, c, h in rows:
            out.setdefault((s, i), {})[c] = h
        return out

    a, b = by_id(old), by_id(new)
    want = {
        k: "new" if k not in a else "removed" if k not in b
        else "unchanged" if a[k] == b[k] else "changed"
        for k in {*a, *b}
    }
    assert {(r["source"], r["id"]): r["change"] for r in got.collect()} == want


def test_first_of_a_hot_archive(spark, skew_settings):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < HOT else f"a{i % 40}", rnd.choice("xyz"), i, f"n{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "archive string, channel string, member_no int, member string")
    want = {}
    for a, c, no, name in rows:
        want.setdefault((a, c), (no, name))
    got = M.first_channel_wins(df, ["archive"]).collect()
    assert {(r["archive"], r["channel"]): (r["member_no"], r["member"]) for r in got} == want


def test_hot_requests_and_repeated_ranges(spark, skew_settings):
    rm = spark.createDataFrame(
        [("s", "1k", f"m{i}", "color", f"f{i % 3}", i, 1) for i in range(50)] * 3,
        "source string, tier string, id string, channel string, parquet_file string, "
        "offset bigint, length bigint",
    )
    files = rm.select("tier", "source").distinct()
    rnd = random.Random(5)
    asked = [(n, "s", "1k", "m7" if rnd.random() < HOT else f"m{rnd.randint(0, 80)}", "color") for n in range(400)]
    df = spark.createDataFrame(asked, "n int, source string, tier string, id string, channel string")
    got = {r["n"]: (r["offset"], r["error_kind"]) for r in L.lookup_texture(df, files, rm).collect()}
    assert got == {
        n: (int(i[1:]), None) if int(i[1:]) < 50 else (None, "material") for n, _, _, i, _ in asked
    }


def test_hash_maps_of_a_repeated_material(spark):
    rows = [("s", "hot", "color", "1", 5)] * 300 + [("s", "hot", "ao", "2", 6), ("s", "b", "ao", "3", 7)]
    df = spark.createDataFrame(rows, SCHEMA + ", length bigint")
    got = {r["id"]: (r["maps"], {k: tuple(v) for k, v in r["texture_hashes"].items()})
           for r in P.texture_hashes(df, ["source", "id"]).collect()}
    assert got == {
        "hot": (["ao", "color"], {"ao": ("2", 6), "color": ("1", 5)}), "b": (["ao"], {"ao": ("3", 7)}),
    }
