import io
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetlake.operators import quality as Q
from assetlake.operators import releases as R
from assetlake.operators import usage as U
from assetlake.plans.bake import archive_textures
from assetlake.sinks import documents as O
from assetlake.sources import bundles as B
from assetlake.sources import metadata as M


def snap(spark, rows):
    return spark.createDataFrame(rows, "source string, id string, channel string, sha256 string")


def test_diff_classifies_by_channel_set_and_hash(spark):
    old = snap(spark, [("s", "same", "color", "1"), ("s", "hash", "color", "1"),
                       ("s", "more", "color", "1"), ("s", "gone", "color", "1")])
    new = snap(spark, [("s", "same", "color", "1"), ("s", "hash", "color", "2"),
                       ("s", "more", "color", "1"), ("s", "more", "ao", "1"), ("s", "new", "ao", "1")])
    want = {"same": "unchanged", "hash": "changed", "more": "changed", "gone": "removed", "new": "new"}
    assert {r["id"]: r["change"] for r in R.diff_snapshots(old, new).collect()} == want
    plan = {r["id"]: r["action"] for r in R.plan_refresh(old, new).collect()}
    assert plan == {"same": "carry", "hash": "bake", "more": "bake", "gone": "tombstone", "new": "bake"}


keys = st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from("123"), max_size=8)


@settings(max_examples=5, deadline=None)
@given(keys, keys)
def test_diff_partitions_the_keys_and_a_delta_gives_the_new_snapshot(spark, old, new):
    def table(d):
        return snap(spark, [("s", k, "color", v) for k, v in d.items()])

    diff = {r["id"]: r["change"] for r in R.diff_snapshots(table(old), table(new)).collect()}
    assert set(diff) == set(old) | set(new)
    changed = {k: v for k, v in new.items() if diff[k] in ("new", "changed")}
    releases = spark.createDataFrame([("v1", None), ("v2", "v1")], "release_tag string, base_release string")
    rows = table(old).withColumn("release_tag", F.lit("v1")).unionByName(
        table(changed).withColumn("release_tag", F.lit("v2"))
    )
    gone = spark.createDataFrame(
        [("v2", "s", k) for k, c in diff.items() if c == "removed"],
        "release_tag string, source string, id string",
    )
    flat = {r["id"]: r["sha256"] for r in R.flatten_release(releases, rows, gone, "v2").collect()}
    assert flat == new


def test_release_chain_stops_at_cycles(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")],
                                  "release_tag string, base_release string")
    assert {r["release_tag"]: r["depth"] for r in R.release_chain(chain, "a").collect()} == {"a": 0, "b": 1}
    with pytest.raises(Exception, match="cycle"):
        R.release_chain(chain, "x").collect()


def test_release_chain_has_no_longest(spark):
    rows = [(str(i), str(i - 1) if i else None) for i in range(300)]
    releases = spark.createDataFrame(rows, "release_tag string, base_release string")
    got = {int(r["release_tag"]): r["depth"] for r in R.release_chain(releases, "299").collect()}
    assert got == {i: 299 - i for i in range(300)}
    assert R.release_chain(releases, "unknown").isEmpty()


def test_delta_manifests_resolve_from_files(spark, tmp_path):
    from assetlake.sinks.files import write_files

    plan = spark.createDataFrame(
        [("s", "1", "unchanged", "carry"), ("s", "2", "changed", "bake"), ("s", "3", "removed", "tombstone")],
        "source string, id string, change string, action string",
    )
    placed = spark.createDataFrame(
        [("s", "1", "1k", "a"), ("s", "2", "1k", "b"), ("s", "3", "1k", "b")],
        "source string, id string, tier string, file_name string",
    )
    files = R.delta_manifest(plan, placed, "v2", "v1")
    write_files(R.delta_document(files, plan), str(tmp_path))
    got = M.read_delta_manifests(spark, f"{tmp_path}/v2")
    rows = {(r["file_name"], r["from"]) for r in M.explode_delta(got).collect()}
    assert rows == {("a", "v1"), ("b", "v2")}
    assert [tuple(r) for r in M.removed_by(got).collect()] == [("v2", "s", "3")]


def test_requests_resolve_to_manifest_then_tag_then_newest(spark):
    tags = spark.createDataFrame([("v2026.04.2",), ("v2026.04.10",), ("x",)], "release_tag string")
    asked = spark.createDataFrame(
        [(1, "t", "m"), (2, "t", None), (3, None, None)], "n int, tag string, manifest string"
    )
    got = {r["n"]: r["resolved"] for r in M.resolve_releases(asked, tags).collect()}
    assert got == {1: "m", 2: "t", 3: "v2026.04.10"}


def test_overlay_takes_the_nearest_release(spark):
    releases = spark.createDataFrame([("v3", "v2"), ("v2", "v1"), ("v1", None)],
                                     "release_tag string, base_release string")
    files = spark.createDataFrame(
        [("v1", "1k", "s", "a"), ("v1", "1k", "s", "b"), ("v2", "1k", "s", "b"), ("v9", "1k", "s", "c")],
        "release_tag string, tier string, source string, file_name string",
    )
    got = {r["file_name"]: r["from"] for r in R.resolve_overlay(releases, files, "v3").collect()}
    assert got == {"a": "v1", "b": "v2"}


def test_manifest_round_trip(spark, tmp_path):
    names = spark.createDataFrame([(n,) for n in (
        "assetlake-a-1k-metal.parquet", "assetlake-a-1k-wood-2.parquet", "a-1k-metal-rowmap.json",
        "assetlake-g-ktx2-1k-other.parquet", "b-1k-metal-rowmap.json", "readme.md",
    )], "file_name string")
    doc = R.manifest_document(R.manifest_rollup(names), "v2026.04.0", "https://x/").first()
    (tmp_path / "m.json").write_text(doc["content"])
    rows = {(r["tier"], r["source"], r["kind"], r["file_name"])
            for r in M.read_manifest_files(spark, str(tmp_path / "m.json")).collect()}
    assert rows == {
        ("1k", "a", "bundle", "assetlake-a-1k-metal.parquet"),
        ("1k", "a", "bundle", "assetlake-a-1k-wood-2.parquet"),
        ("1k", "a", "rowmap", "a-1k-metal-rowmap.json"),
        ("ktx2-1k", "g", "bundle", "assetlake-g-ktx2-1k-other.parquet"),
    }


def test_manifest_versions_and_old_single_rowmap(spark, tmp_path):
    old = '{"schema_version": 1, "release_tag": "v1", "tiers": {"1k": {"base_url": "u", "sources": {"a": {"parquet_files": ["p"], "rowmap_file": "r.json"}}}}}'
    (tmp_path / "old.json").write_text(old)
    kinds = {r["kind"]: r["file_name"] for r in M.read_manifest_files(spark, str(tmp_path / "old.json")).collect()}
    assert kinds == {"bundle": "p", "rowmap": "r.json"}
    for body in ('{"release_tag": "v1"}', '{"schema_version": 2}'):
        (tmp_path / "bad.json").write_text(body)
        with pytest.raises(M.UnknownSchemaVersion):
            M.read_manifest_files(spark, str(tmp_path / "bad.json"))


def test_latest_release_orders_numbers(spark):
    tags = spark.createDataFrame([("v2026.04.9",), ("v2026.04.10",), ("nightly",)], "release_tag string")
    assert M.resolve_release(tags) == "v2026.04.10"
    assert M.resolve_release(tags, "v1") == "v1"
    assert M.resolve_release(tags, "v1", "path") == "path"
    assert M.newer_available(tags, "v2026.04.9").first()["newer"]


def test_reconcile(spark):
    schema = "file_name string, size bigint"
    e = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema)
    a = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], schema)
    assert {r["file_name"]: r["problem"] for r in R.reconcile(e, a).collect()} == {
        "b": "wrong_size", "c": "missing", "d": "unexpected",
    }


def zip_bytes(members, method=zipfile.ZIP_STORED):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", method) as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def test_archive_safety(spark, tmp_path):
    files = {
        "fine": zip_bytes([("a_Color.png", b"\x89PNG1"), ("x/../b_Color.png", b"second")]),
        "slip": zip_bytes([("../evil_Color.png", b"x")]),
        "deep": zip_bytes([("a/../../b.png", b"x")]),
        "abs": zip_bytes([("/etc/x.png", b"x")]),
        "bomb": zip_bytes([("z", b"\0" * 10**6)], zipfile.ZIP_DEFLATED),
        "wide": zip_bytes([("z", bytes(range(256)) * 8000)]),
    }
    for name, data in files.items():
        (tmp_path / f"{name}.zip").write_bytes(data)
    (tmp_path / "broken.zip").write_bytes(b"PK nothing")
    members = B.read_archives(spark, str(tmp_path))
    out = Q.archive_safety(members, max_total=3 * 10**6, max_file=2 * 10**6).collect()
    got = {r["archive"].rsplit("/", 1)[-1][:-4]: r["violation"] for r in out}
    assert got == {
        "fine": None, "slip": "path_escape", "deep": "path_escape", "abs": "path_escape",
        "bomb": "ratio_too_high", "wide": "file_too_large", "broken": "unreadable",
    }
    rows = archive_textures(spark, str(tmp_path), "ambientcg").collect()
    assert {(r["id"], r["channel"], bytes(r["payload"])) for r in rows} == {
        ("fine", "color", b"\x89PNG1"), ("slip", "color", b"x"),
    }


def test_retention_and_usage(spark):
    files = spark.createDataFrame(
        [("v1/a/1k/x/color.png", 5), ("v1/a/2k/x/color.png", 7), ("v2/a/1k/x/color.png", 11),
         ("v1/.rowmaps/r.json", 2), (".manifest.json", 1)], "file string, length bigint",
    )
    inv = U.parse_inventory(files)
    use = {(r["scope"], r["tag"], r["tier"]): (r["bytes"], r["files"]) for r in U.storage_usage(inv).collect()}
    assert use["total", None, None] == (26, 5) and use["meta", None, None] == (3, 2)
    assert use["cell", "v1", "1k"] == (5, 1)

    def plan(**kw):
        return sorted(r["length"] for r in U.retention_plan(inv, **kw).collect())

    assert plan(keep_tags=["v2"]) == [2, 5, 7]
    assert plan(tier="1k") == [5, 11]
    assert plan(tag="v2") == [11]
    assert plan() == []
    assert U.over_cap(inv, 25).first()["over"] and not U.over_cap(inv, 0).first()["over"]


def test_documents_last_path_wins_and_size_guard(spark):
    docs = spark.createDataFrame(
        [("s", "a", "p1", "<old/>"), ("s", "a", "p2", "<new/>"), ("s", "b", "p1", "<b/>")],
        "source string, id string, path string, xml string",
    )
    assert O.document_map(docs).first()["content"] == '{"a":"<new/>","b":"<b/>"}'
    with pytest.raises(O.DocumentMapTooLarge):
        O.document_map(docs, 5)


def test_check_index(spark):
    row = dict(id="x", source="ambientcg", name="n", category="metal", tags=[], source_url="u",
               source_license="l", available_tiers=["1k"], maps=["color"], last_updated="2026-04-18",
               color_hex="#10EC54E", roughness=1.5, metalness=0.5, ior=-1.0, source_mtlx_url=None,
               texture_hashes=None, status=None)
    from assetlake import schemas as S

    fine = {**row, "id": "ok", "color_hex": "#A0522D", "roughness": 1.0, "ior": 1.5}
    index = spark.createDataFrame([row, fine, {**fine, "id": "twice"}, {**fine, "id": "twice"}], S.INDEX_SCHEMA)
    got = {(r["id"], r["rule"]) for r in Q.check_index(index).collect()}
    assert got == {("x", "color_pattern"), ("x", "roughness_range"), ("x", "ior_range"), ("twice", "duplicate_id")}
