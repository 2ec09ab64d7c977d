"""Faults that tables of 6 GB showed in the queries."""

from __future__ import annotations

import io
import tracemalloc

import pyarrow.parquet as pq
import pytest
from assetlake import schemas as S
from assetlake.functions import parquet as Q
from assetlake.operators import rowmap as M
from assetlake.sinks import bundles as K
from assetlake.sources import bundles as R
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

KEYS = "source string, tier string, category string, id string"


def wide_row(i: int) -> tuple:
    """A bundle row with values of all lengths, nulls and text beyond ASCII."""
    row = {"id": f"m{i:06d}", "source": "s", "category": "café" * (i % 3), "resolution_px": i - 5, "source_url": None}
    row |= {"source_license": "CC0-1.0", "baker_version": "x" * (5000 if i == 7 else 1), "baked_at": "now"}
    row |= {c: None if (i + k) % 3 else bytes([i % 256]) * (i * 37 % 9000) for k, c in enumerate(S.CHANNELS)}
    return tuple(row[f.name] for f in S.BUNDLE_SCHEMA.fields)


def file_of(rows, out=None):
    out = out or io.BytesIO()
    writer = Q.RowGroupWriter(out, S.BUNDLE_SCHEMA, {"id", "resolution_px", "category", "baker_version"}, {"k": "v"})
    for row in rows:
        writer.write(row)
    writer.close()
    return out


def test_row_groups_of_one_row_read_as_written(spark, tmp_path):
    rows = [wide_row(i) for i in range(40)]
    data = file_of(rows).getvalue()
    (tmp_path / "b.parquet").write_bytes(data)
    table = pq.read_table(io.BytesIO(data), page_checksum_verification=True)
    assert [tuple(r.values()) for r in table.to_pylist()] == rows
    meta = pq.ParquetFile(io.BytesIO(data)).metadata
    assert meta.num_row_groups == meta.num_rows == 40 and meta.metadata[b"k"] == b"v"
    for g, row in enumerate(rows):
        for c, (f, value) in enumerate(zip(S.BUNDLE_SCHEMA.fields, row, strict=True)):
            chunk = meta.row_group(g).column(c)
            assert (chunk.compression, chunk.num_values, chunk.statistics.null_count) == ("UNCOMPRESSED", 1, value is None)
            known = f.name in ("id", "resolution_px", "category") or f.name == "baker_version" and len(value) < 2048
            assert chunk.statistics.has_min_max == known
            assert not known or chunk.statistics.min == chunk.statistics.max == value
            if f.name in S.CHANNELS and value is not None:
                end = chunk.data_page_offset + chunk.total_compressed_size
                assert data[end - len(value) : end] == value
    got = spark.read.parquet(f"{tmp_path}/b.parquet")
    assert got.schema == S.BUNDLE_SCHEMA and sorted(map(tuple, got.collect())) == sorted(rows)
    assert got.filter("id = 'm000011' AND resolution_px = 6").count() == 1


@pytest.mark.parametrize("portion", [300, 20_000, Q.PORTION_BYTES])
def test_footer_in_portions_is_the_whole_footer(spark, tmp_path, monkeypatch, portion):
    """Also of files of other writers, some with several rows in a row group."""
    files = [tmp_path / f"{i}.parquet" for i in range(3)]
    files[0].write_bytes(file_of([wide_row(i) for i in range(60)]).getvalue())
    spark.read.parquet(str(files[0])).repartition(2).write.option("parquet.block.row.count.limit", "7").parquet(f"{tmp_path}/spark")
    files[2].write_bytes(next((tmp_path / "spark").glob("*.parquet")).read_bytes())
    pq.write_table(pq.read_table(files[0]), files[1], row_group_size=9, compression="snappy")
    monkeypatch.setattr(Q, "FOOTER_BYTES", 100)
    monkeypatch.setattr(Q, "PORTION_BYTES", portion)
    for file in files:
        whole = pq.ParquetFile(file).metadata
        with R.open_path(str(file)) as fh:
            parts = list(Q.footer_portions(fh))
        assert {n for n, _, _ in parts} == {whole.num_row_groups}
        groups = [(first + g, m.row_group(g).to_dict()) for _, first, m in parts for g in range(m.num_row_groups)]
        assert groups == [(g, whole.row_group(g).to_dict()) for g in range(whole.num_row_groups)]
        assert len(parts) > 1 or portion > 300


def test_memory_of_a_bundle_does_not_grow_with_its_rows(tmp_path, monkeypatch):
    """Before, entries of all row groups were objects in the writing and in the reading task."""
    monkeypatch.setattr(Q, "FOOTER_BYTES", 1 << 17)
    monkeypatch.setattr(Q, "PORTION_BYTES", 1 << 16)
    peaks = []
    for n in (1000, 6000):
        path = tmp_path / f"{n}.parquet"
        tracemalloc.start()
        with path.open("wb") as out:
            file_of((wide_row(i % 100) for i in range(n)), out)
        with R.open_path(str(path)) as fh:
            seen = sum(m.num_row_groups for _, _, m in Q.footer_portions(fh))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert seen == n
    assert peaks[1] < 1.3 * peaks[0] < 4 << 20


def test_bundles_are_written_as_modes_say(spark, tmp_path):
    def rows(*names):
        return spark.createDataFrame([(n, *wide_row(i)) for n in names for i in range(3)], f"bundle string, {ddl()}").coalesce(1)

    path = str(tmp_path / "b")
    K.write_sorted(rows("a=1/b", "a"), path, "errorifexists")
    with pytest.raises(AnalysisException):
        K.write_sorted(rows("c"), path, "errorifexists")
    K.write_sorted(rows("a"), path, "append")
    K.write_sorted(rows("d"), path, "ignore")
    got = {r["bundle"]: r["count"] for r in spark.read.parquet(path).groupBy("bundle").count().collect()}
    assert got == {"a=1/b": 3, "a": 6}  # folders are named as Spark names them
    K.write_sorted(rows("e"), path, "overwrite")
    assert {f.parent.name for f in (tmp_path / "b").rglob("*.parquet")} == {"bundle=e"}
    assert (tmp_path / "b/_SUCCESS").exists() and len(list((tmp_path / "b/bundle=e").iterdir())) == 1
    failing = rows("f").withColumn("id", F.raise_error(F.lit("no id")).cast("string"))
    with pytest.raises(Exception, match="no id"):
        K.write_sorted(failing, str(tmp_path / "g"), "errorifexists")
    assert list((tmp_path / "g").iterdir()) == []


def ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.BUNDLE_SCHEMA.fields)


def test_a_row_is_compared_with_few_of_many_bundles(spark, monkeypatch):
    """Before: one join with all bundles of the group, so rows times bundles."""
    monkeypatch.setattr(K, "FAN_OUT", 3)
    places = [("s", c, i) for c in ("metal", "wood") for i in range(2, 40 if c == "wood" else 5)]
    names = {(c, i): f"{c}-{i}.parquet" for _, c, i in places}
    ranges = [(s, "1k", c, i, f"{i:03d}0", f"{i:03d}6", names[c, i], n) for n, (s, c, i) in enumerate(places)]
    bundles = spark.createDataFrame(
        [*ranges, (None, "1k", "wood", 1, "0010", "9999", "none.parquet", 99)],
        "source string, tier string, category string, chunk int, first_id string, last_id string, parquet_file string, bundle_no int",
    )
    ids = [None, *(f"{i:03d}{k}" for i in range(45) for k in range(0, 10, 3))]
    rows = [(s, "1k", c, i) for s in ("s", "t", None) for c in ("metal", "wood", None) for i in ids]
    rows = spark.createDataFrame([*rows, *rows[:300]], KEYS)
    out = K.with_bundle(rows, rows, bundles)
    want = [r for r in rows.collect() if r.source == "s" and r.id and (r.category, int(r.id[:3])) in names and r.id[3] <= "6"]
    assert out.columns == [*rows.columns, "parquet_file", "bundle_no"]
    got = sorted((*r[:4], r.parquet_file) for r in out.collect())
    assert got == sorted((*r, names[r.category, int(r.id[:3])]) for r in want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "Exchange hashpartitioning" not in plan  # 38 bundles, 3 a level


def test_textures_are_placed_once_for_a_rowmap(spark, tmp_path):
    """Before, the search for the bundles was repeated by every step of the rowmap."""
    (tmp_path / "f.parquet").write_bytes(file_of([wide_row(0)]).getvalue())
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    row = dict(zip([f.name for f in S.BUNDLE_SCHEMA.fields], wide_row(0), strict=True))
    there = [("f.parquet", "m000000", c, len(row[c])) for c in S.CHANNELS if row[c] is not None]
    schema = "parquet_file string, id string, channel string, length bigint"
    placed = spark.createDataFrame(there, schema).mapInArrow(note, schema)
    foot = R.footers(R.list_files(spark, str(tmp_path), "*.parquet"))
    assert M.build_rowmap(foot, M.collector(placed)).count() == len(there)
    assert seen.value == len(there)
