import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import png
from assetlake.operators import lookup as L
from assetlake.operators import quality as Q
from assetlake.operators import rowmap as M
from assetlake.plans import derive as D
from assetlake.sinks import bundles as K
from assetlake.sinks.files import apply_renames, inventory, rename_plan, write_files
from assetlake.sources import bundles as R

PNG = png.SIGNATURE + b"data" + b"\0\0\0\0IEND\xaeB`\x82"
SCHEMA = "source string, tier string, category string, id string, channel string, payload binary"


def textures(spark, n=9, hot=0.7):
    rows = []
    for i in range(n):
        cat = "other" if i < n * hot else "metal"
        for c in ("color", "normal") if i % 3 else ("color",):
            rows.append(("s", "1k", cat, f"m{i:03d}", c, bytearray(PNG[:8] + bytes([i]) * (50 + i) + PNG[8:])))
    df = spark.createDataFrame(rows, SCHEMA)
    return rows, df.withColumn("length", F.octet_length("payload").cast("long"))


def records(spark, n=9):
    return spark.createDataFrame(
        [("s", f"m{i:03d}", f"https://x/{i}", "CC0-1.0") for i in range(n)],
        "source string, id string, source_url string, source_license string",
    )


def test_bundles_have_one_row_per_group_and_ranges_give_the_payload(spark, tmp_path):
    rows, df = textures(spark)
    path = str(tmp_path / "b")
    chunks, bundles = K.write_partitioned_bundle(df, records(spark), path, "1", "now", 300)
    assert bundles.agg(F.max("bytes")).first()[0] < 2 * 300
    rowmap = D.rowmap_of(spark, path, df.drop("payload"), chunks, bundles)
    assert rowmap.count() == len(rows)
    assert apply_renames(rename_plan(spark, path)) == bundles.count()
    files = {f.name: f for f in (tmp_path / "b").glob("*.parquet")}
    assert set(files) == {r["parquet_file"] for r in bundles.collect()}
    want = {(r[3], r[4]): bytes(r[5]) for r in rows}
    for r in rowmap.collect():
        data = files[r["parquet_file"]].read_bytes()
        assert data[r["offset"] : r["offset"] + r["length"]] == want[r["id"], r["channel"]]
    for f in files.values():
        meta = pq.ParquetFile(f).metadata
        table = pq.read_table(f)
        assert meta.num_row_groups == table.num_rows
        assert table["id"].to_pylist() == sorted(table["id"].to_pylist())
        assert set(S.CHANNELS) < set(table.column_names)
        assert all(u.startswith("https://x/") for u in table["source_url"].to_pylist())


def test_reading_scalars_leaves_payloads_alone(spark, tmp_path):
    _, df = textures(spark)
    path = str(tmp_path / "b")
    K.write_partitioned_bundle(df, records(spark), path, "1", "now")
    out = R.read_bundle(spark, path)
    assert "binary" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert R.read_bundle(spark, path, ["color"]).filter("color is not null").count() == 9


def test_writing_shuffles_payloads_once(spark):
    _, df = textures(spark)
    chunks, bundles = K.plan_bundles(df.drop("payload"), 300)
    rows = K.with_bundle(df, chunks, bundles)
    wide = rows.repartitionById(3, "bundle_no").groupBy("bundle_no", "id").agg(F.max("payload"))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionid") == 1 and "Exchange hashpartitioning" not in plan


def test_only_planned_materials_are_written(spark, tmp_path):
    rows, df = textures(spark)
    planned = df.drop("payload").filter("id <> 'm001'")
    path = str(tmp_path / "b")
    K.write_partitioned_bundle(df, records(spark), path, "1", "now", planned=planned)
    got = {r["id"] for r in R.read_bundle(spark, path).collect()}
    assert got == {r[3] for r in rows} - {"m001"}


def test_nothing_to_write_is_an_error(spark, tmp_path):
    _, df = textures(spark)
    with pytest.raises(ValueError):
        K.write_partitioned_bundle(df.filter("false"), records(spark), str(tmp_path / "b"), "1", "now")
    wide = spark.createDataFrame([], S.BUNDLE_SCHEMA)
    with pytest.raises(ValueError):
        K.write_bundle(wide, str(tmp_path / "c"))


def bundle_file(path, rows):
    """A bundle file made with another writer: one row group per row."""
    schema = pa.schema([("id", pa.string()), *[(c, pa.binary()) for c in S.CHANNELS]])
    with pq.ParquetWriter(path, schema, compression="NONE", use_dictionary=False) as w:
        for row in rows:
            w.write_table(pa.table({f.name: [row.get(f.name)] for f in schema}, schema=schema))


def recorded(spark, rows):
    return spark.createDataFrame(
        rows, "parquet_file string, row_idx int, id string, channel string, length bigint"
    )


def test_rowmap_of_png_ktx2_and_null_channels(spark, tmp_path):
    ktx = S.KTX2_MAGIC + bytes(9000)  # too long for a copy in the page statistics
    bundle_file(tmp_path / "b.parquet", [{"id": "a", "color": PNG, "normal": ktx}, {"id": "b", "ao": PNG}])
    foot = R.footers(R.list_files(spark, str(tmp_path), "*.parquet"))
    rec = recorded(spark, [
        ("b.parquet", 0, "a", "color", len(PNG)), ("b.parquet", 0, "a", "normal", len(ktx)),
        ("b.parquet", 1, "b", "ao", len(PNG)),
    ])
    data = (tmp_path / "b.parquet").read_bytes()
    got = M.build_rowmap(foot, rec).collect()
    assert {(r["id"], r["channel"]) for r in got} == {("a", "color"), ("a", "normal"), ("b", "ao")}
    for r in got:
        part = data[r["offset"] : r["offset"] + r["length"]]
        assert part == (ktx if r["channel"] == "normal" else PNG)


def test_payloads_that_hold_magics_keep_their_ranges(spark, tmp_path):
    odd = {"color": bytes(9000) + PNG + b"IEND" + PNG, "normal": PNG + S.KTX2_MAGIC + bytes(5000), "ao": b"x"}
    bundle_file(tmp_path / "b.parquet", [{"id": "a", **odd}])
    foot = R.footers(R.list_files(spark, str(tmp_path), "*.parquet"))
    rec = recorded(spark, [("b.parquet", 0, "a", c, len(v)) for c, v in odd.items()])
    data = (tmp_path / "b.parquet").read_bytes()
    got = {r["channel"]: data[r["offset"] : r["offset"] + r["length"]] for r in M.build_rowmap(foot, rec).collect()}
    assert got == odd
    wrong = recorded(spark, [("b.parquet", 0, "z", c, len(v)) for c, v in odd.items()])
    with pytest.raises(ValueError, match="no place for z"):
        M.build_rowmap(foot, wrong)


def test_rowmap_count_mismatch_and_oversized_length(spark, tmp_path):
    bundle_file(tmp_path / "b.parquet", [{"id": "a", "color": PNG}, {"id": "b", "color": PNG}])
    foot = R.footers(R.list_files(spark, str(tmp_path), "*.parquet"))
    with pytest.raises(ValueError, match="1 recorded rows but 2 row groups"):
        M.build_rowmap(foot, recorded(spark, [("b.parquet", 0, "a", "color", len(PNG))]))
    rec = recorded(spark, [("b.parquet", 0, "a", "color", 10**6), ("b.parquet", 1, "b", "color", 4)])
    with pytest.raises(ValueError, match="no place for a/color"):
        M.build_rowmap(foot, rec)


def test_empty_bundle_gets_an_empty_rowmap(spark, tmp_path):
    bundle_file(tmp_path / "assetlake-s-1k-other-7.parquet", [])
    foot = R.footers(R.list_files(spark, str(tmp_path), "*.parquet"))
    assert foot.collect()[0]["n_row_groups"] == 0
    files = spark.createDataFrame([("assetlake-s-1k-other-7.parquet", "s", "1k")],
                                  "parquet_file string, source string, tier string")
    long = M.build_rowmap(foot, recorded(spark, []))
    doc = M.rowmap_documents(long, files, "v2026.04.0").collect()[0]
    assert doc["file"] == "s-1k-other-7-rowmap.json"
    assert doc["content"].endswith('"materials":{}}')


def ranges(spark, rows):
    return spark.createDataFrame(
        rows,
        "source string, tier string, id string, channel string, parquet_file string, "
        "offset bigint, length bigint",
    )


def test_fetch_reports_problems_as_rows(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"xx" + PNG + b"junk")
    n = len(PNG)
    rm = ranges(spark, [
        ("s", "1k", "ok", "color", "f", 2, n), ("s", "1k", "zero", "color", "f", 2, 0),
        ("s", "1k", "neg", "color", "f", 2, -4), ("s", "1k", "big", "color", "f", 2, 10**12),
        ("s", "1k", "junk", "color", "f", 2 + n, 4), ("s", "1k", "end", "color", "f", 2, n + 99),
        ("s", "1k", "lost", "color", "g", 0, 4),
    ])
    files = spark.createDataFrame([("f", str(tmp_path / "f"))], "parquet_file string, path string")
    asked = rm.select("source", "tier", "id", "channel")
    asked = asked.union(asked).union(asked.limit(1).withColumn("id", F.lit("none")))
    got = {r["id"]: r for r in R.fetch_ranges(asked, rm, files).collect()}
    assert bytes(got["ok"]["payload"]) == PNG and got["ok"]["error_kind"] is None
    assert {k: r["error_kind"] for k, r in got.items() if k != "ok"} == {
        "zero": "bad_length", "neg": "bad_length", "big": "bad_length", "junk": "bad_magic",
        "end": "short_read", "lost": "no_file", "none": "not_in_rowmap",
    }
    assert all(r["payload"] is None for k, r in got.items() if k != "ok")


FIXTURE = [
    ("a", "1k", "Rock064", "color", "b1", 0, 1024), ("a", "1k", "Rock064", "normal", "b1", 1024, 2048),
    ("a", "1k", "Rock064", "roughness", "b1", 3072, 512),
    ("a", "1k", "Metal032", "color", "b1", 4000, 800),
    ("g", "1k", "test-uuid", "color", "b2", 0, 1024),
]


def test_lookup_names_the_first_missing_level(spark):
    rm = ranges(spark, FIXTURE)
    files = rm.select("tier", "source").distinct()
    asked = spark.createDataFrame([
        ("a", "1k", "Rock064", "normal"), ("a", "9k", "Rock064", "normal"), ("z", "1k", "Rock064", "x"),
        ("a", "1k", "Rock999", "color"), ("a", "1k", "Metal032", "ao"),
    ], "source string, tier string, id string, channel string")
    got = {(r["source"], r["tier"], r["id"], r["channel"]): r
           for r in L.lookup_texture(asked, files, rm).collect()}
    hit = got["a", "1k", "Rock064", "normal"]
    assert (hit["offset"], hit["length"], hit["error_kind"]) == (1024, 2048, None)
    assert (got["a", "9k", "Rock064", "normal"]["error_kind"], got["a", "9k", "Rock064", "normal"]["available"]) == ("tier", ["1k"])
    assert got["z", "1k", "Rock064", "x"]["available"] == ["a", "g"]
    assert got["a", "1k", "Rock999", "color"]["error_kind"] == "material"
    assert got["a", "1k", "Metal032", "ao"]["available"] == ["color"]


def test_merge_keeps_the_last_file(spark):
    rows = [("a", "1k", "x", "color", "f1", 0, 1), ("a", "1k", "x", "ao", "f1", 1, 1),
            ("a", "1k", "x", "color", "f2", 5, 1)]
    got = M.merge_rowmaps(ranges(spark, rows)).collect()
    assert [(r["channel"], r["offset"]) for r in got] == [("color", 5)]


def test_check_rowmap_finds_overlap_with_any_earlier_range(spark):
    rows = [("ambientcg", "1k", "a", "color", "f", 0, 100), ("ambientcg", "1k", "b", "color", "f", 10, 5),
            ("ambientcg", "1k", "c", "color", "f", 50, 5), ("ambientcg", "1k", "d", "gloss", "f", 100, 5)]
    rm = ranges(spark, rows).withColumn("release_tag", F.lit("v2026.04.0"))
    got = {(r["id"], r["rule"]) for r in Q.check_rowmap(rm).collect()}
    assert got == {("b", "overlap"), ("c", "overlap"), ("d", "channel_enum")}


def test_png_codec_round_trip_and_filters():
    rnd = np.random.default_rng(1)
    px = rnd.integers(0, 256, (13, 7, 3), dtype=np.uint8)
    assert (png.decode_rgb(png.encode_rgb(px)) == px).all()
    import struct
    import zlib

    def with_filters(px):
        """Encode with all five row filters in turn."""
        rows, prev = b"", np.zeros(px.shape[1] * 3, int)
        for y, line in enumerate(px.reshape(px.shape[0], -1).astype(int)):
            left = np.concatenate([[0, 0, 0], line[:-3]])
            corner = np.concatenate([[0, 0, 0], prev[:-3]])
            p = left + prev - corner
            a, b, c = abs(p - left), abs(p - prev), abs(p - corner)
            paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, prev, corner))
            kind = y % 5
            guess = [0 * line, left, prev, (left + prev) // 2, paeth][kind]
            rows += bytes([kind]) + bytes(((line - guess) % 256).astype(np.uint8))
            prev = line

        def chunk(k, body):
            return struct.pack(">I", len(body)) + k + body + struct.pack(">I", zlib.crc32(k + body))

        head = struct.pack(">IIBBBBB", px.shape[1], px.shape[0], 8, 2, 0, 0, 0)
        return png.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

    assert (png.decode_rgb(with_filters(px)) == px).all()


def test_derive_shrinks_keeps_small_ones_and_nulls_broken_ones(spark):
    flat = np.full((64, 32, 3), (200, 10, 30), np.uint8)
    small = png.encode_rgb(flat[:8, :8])
    rows = [
        ("s", "1k", "metal", "a", "color", bytearray(png.encode_rgb(flat))),
        ("s", "1k", "metal", "a", "normal", bytearray(small)),
        ("s", "1k", "stone", "b", "color", bytearray(b"\x89PNG broken")),
    ]
    big = spark.createDataFrame(rows, SCHEMA)
    out = {(r["id"], r["channel"]): r for r in D.resized(big, 16).collect()}
    assert set(out) == {("a", "color"), ("a", "normal")}
    assert bytes(out["a", "normal"]["payload"]) == small
    got = png.decode_rgb(bytes(out["a", "color"]["payload"]))
    assert got.shape == (16, 8, 3) and (got == (200, 10, 30)).all()
    kept = D.map_payloads(big, lambda d, _: png.shrink(d, 16), keep_failed=True)
    assert kept.filter("error is not null").count() == 1
    with pytest.raises(ValueError):
        D.derive_tier(big, "1k", "2k")


def test_transcode_checks_the_output(spark):
    _, df = textures(spark, 3)
    modes = D.transcode_tier(df, "1k", lambda d, mode: S.KTX2_MAGIC + mode.encode()).collect()
    assert {(r["channel"], bytes(r["payload"])[12:].decode()) for r in modes} == {
        ("color", "srgb"), ("normal", "normal"),
    }
    assert {r["tier"] for r in modes} == {"ktx2-1k"}
    assert D.transcode_tier(df, "1k", lambda d, mode: b"no magic").count() == 0


def test_files_are_written_once(spark, tmp_path):
    root = str(tmp_path / "t")
    files = spark.createDataFrame([("a/x.png", "one"), ("b/y.png", "two")], "file string, content string")
    assert write_files(files, root, skip_existing=True) == (2, 6)
    assert write_files(files, root, skip_existing=True) == (0, 0)
    assert {(r["file"], r["length"]) for r in inventory(spark, root).collect()} == {
        ("a/x.png", 3), ("b/y.png", 3),
    }
    assert not list((tmp_path / "t").rglob("*.part"))


def test_write_bundle_keeps_ok_rows_only(spark, tmp_path):
    _, df = textures(spark, 3)
    wide = K.pivot_channels(df, ["source", "id", "category"])
    rows = K.bundle_projection(wide, 1024, "1", "now").withColumn(
        "status", F.when(F.col("id") == "m001", "failed").otherwise("ok")
    )
    path = str(tmp_path / "w")
    K.write_bundle(rows.coalesce(1), path)
    (file,) = (tmp_path / "w").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups == 2
    column = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
              for i in range(meta.num_columns)}
    assert column["color"].compression == "UNCOMPRESSED"
    assert column["color"].dictionary_page_offset is None


def test_a_written_release_validates_and_a_lost_rowmap_is_found(spark, tmp_path):
    from assetlake.functions.names import rowmap_name
    from assetlake.operators import releases as V

    _, df = textures(spark)
    path = str(tmp_path / "b")
    chunks, bundles = K.write_partitioned_bundle(df, records(spark), path, "1", "now", 300)
    rowmap = D.rowmap_of(spark, path, df.drop("payload"), chunks, bundles)
    apply_renames(rename_plan(spark, path))
    foot = R.footers(R.list_files(spark, path, "*.parquet"))
    index = df.groupBy("source", "id").agg(
        F.array_sort(F.collect_set("channel")).alias("maps"),
        F.array(F.lit("1k")).alias("available_tiers"),
    )
    names = bundles.select(
        F.lit("bundle").alias("kind"), F.col("parquet_file").alias("file_name")
    ).union(bundles.select(F.lit("rowmap"), rowmap_name("parquet_file")))
    assert V.validate_release(names, rowmap, index, foot).count() == 0
    lost = names.filter("NOT (kind = 'rowmap' AND file_name LIKE '%metal%')")
    got = V.validate_release(lost, rowmap, index.filter("id <> 'm000'"), foot)
    checks = {r["check"] for r in got.collect()}
    assert checks == {"bundle_without_rowmap", "range_without_index_entry"}


def test_sources_that_share_ids_lose_no_file(spark, tmp_path):
    from assetlake.sinks.documents import materialize

    rows = [("s", "a", "color", PNG), ("t", "a", "color", PNG + b"2")]
    textures = spark.createDataFrame(rows, "source string, id string, channel string, payload binary")
    with pytest.raises(ValueError, match="2 payloads for a/color.png"):
        materialize(textures, f"file://{tmp_path}/flat")
    assert materialize(textures, f"file://{tmp_path}/own", by_source=True)[0] == 2
    assert (tmp_path / "own/t/a/color.png").read_bytes() == PNG + b"2"


def test_a_channel_that_comes_twice_has_one_range(spark, tmp_path):
    from assetlake.plans.derive import rowmap_of
    from assetlake.sinks.bundles import write_partitioned_bundle

    rows = [("s", "1k", "metal", "a", "color", PNG), ("s", "1k", "metal", "a", "color", PNG + b"longer"), ("s", "1k", "metal", "b", "ao", PNG)]
    textures = spark.createDataFrame(rows, "source string, tier string, category string, id string, channel string, payload binary")
    textures = textures.withColumn("length", F.length("payload").cast("long"))
    records = spark.createDataFrame([("s", "a", "", ""), ("s", "b", "", "")], "source string, id string, source_url string, source_license string")
    path = f"{tmp_path}/bundles"
    chunks, bundles = write_partitioned_bundle(textures, records, path, "v", "now")
    got = rowmap_of(spark, path, textures.drop("payload"), chunks, bundles).collect()
    assert sorted((r["id"], r["channel"], r["length"]) for r in got) == [("a", "color", len(PNG) + 6), ("b", "ao", len(PNG))]
