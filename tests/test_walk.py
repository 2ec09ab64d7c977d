import pytest

from assetlake.sinks.files import inventory
from assetlake.sources.bundles import read_texture_tree
from assetlake.sources.walk import walk


@pytest.fixture
def tree(tmp_path):
    files = {"a/1k/x/color.png": b"12345", "a/1k/x/normal.png": b"", "a/2k/ü b/color.png": b"1", "top.json": b"{}",
             ".rowmaps/r.json": b"xyz", ".r.json.crc": b"c", "_parts-1/f/0": b"p", "a/_SUCCESS": b""}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty").mkdir()
    return str(tmp_path)


def listed(df):
    return {tuple(r) for r in df.collect()}


def test_files_of_every_depth(spark, tree):
    shown = {("a/1k/x/color.png", 5), ("a/1k/x/normal.png", 0), ("a/2k/ü b/color.png", 1), ("top.json", 2)}
    assert listed(walk(spark, tree)) == {(f"{tree}/{f}", n) for f, n in shown}
    assert listed(walk(spark, tree + "/", "*.json")) == {(f"{tree}/top.json", 2)}
    assert listed(inventory(spark, tree)) == {*shown, (".rowmaps/r.json", 3)}
    both = walk(spark, [f"{tree}/a/1k", f"{tree}/top.json"], "*r.png")
    assert listed(both) == {(f"{tree}/a/1k/x/color.png", 5), (f"{tree}/top.json", 2)}


def test_empty_and_missing_roots(spark, tree):
    assert walk(spark, f"{tree}/empty").count() == 0
    assert walk(spark, f"{tree}/none", missing_ok=True).count() == 0
    assert inventory(spark, f"{tree}/none").columns == ["file", "length"]
    with pytest.raises(FileNotFoundError):
        walk(spark, f"{tree}/none")


def test_a_wide_folder_comes_in_batches(spark, tmp_path):
    for i in range(25):
        (tmp_path / f"{i}.png").write_bytes(b"x" * i)
    import assetlake.sources.walk as W

    before, W.ROWS = W.ROWS, 10
    try:
        assert walk(spark, str(tmp_path)).count() == 25
    finally:
        W.ROWS = before


def test_texture_tree(spark, tree):
    rows = read_texture_tree(spark, f"{tree}/a")
    assert {(r["id"], r["channel"], bytes(r["payload"]), r["length"]) for r in rows.collect()} == {
        ("x", "color", b"12345", 5), ("x", "normal", b"", 0), ("ü b", "color", b"1", 1),
    }
