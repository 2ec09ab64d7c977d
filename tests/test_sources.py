import json

from pyspark.sql import functions as F

from assetlake.operators import lookup as L
from assetlake.operators import select as P
from assetlake.operators import usage as U
from assetlake.plans import catalog as G
from assetlake.sinks import documents as O
from assetlake.sources import bundles as B
from assetlake.sources import listings as S
from assetlake.sources import metadata as M


def write(path, value):
    path.write_text(json.dumps(value))
    return str(path)


def asset(i, attributes):
    downloads = [{"attribute": a, "fullDownloadPath": f"/{i}/{a}"} for a in attributes]
    return {
        "assetId": f"A{i}", "displayName": f"Asset {i}", "displayCategory": "Metal/Steel",
        "tags": ["shiny"], "releaseDate": "2024-05-06T07:08:09",
        "downloadFolders": {"default": {"downloadFiletypeCategories": {"zip": {"downloads": downloads}}}},
    }


def test_paged_assets(spark, tmp_path):
    write(tmp_path / "p1.json", {"foundAssets": [asset(1, ["1K-PNG", "2k-png"]), asset(2, ["1K-JPG"])]})
    write(tmp_path / "p2.json", {"foundAssets": [{"assetId": "A3"}]})
    write(tmp_path / "p3.json", {"foundAssets": []})
    items = S.read_listing_pages(spark, str(tmp_path))
    assert items.count() == 3
    got = S.paged_asset_records(items, "2k").collect()
    assert [(r["id"], r["category"], r["last_updated"], r["available_tiers"]) for r in got] == [
        ("A1", "metal", "2024-05-06", ["2k"]),
    ]
    assert S.paged_asset_records(items, "256").count() == 1
    assert S.paged_asset_records(items, "16k").count() == 0


def test_packages(spark, tmp_path):
    path = write(tmp_path / "g.json", {"results": [
        {"id": "u1", "label": "One", "category": "Wood", "tags": "a, b,", "file_url": "z", "updated_date": "d"},
        {"id": "u2", "tags": ["x"], "category": "Wood"},
    ]})
    got = S.package_records(S.read_listing_pages(spark, path, "results")).orderBy("id").collect()
    assert (got[0]["tags"], got[0]["category"], got[0]["source_license"]) == (["a", "b"], "wood", "TBV")
    assert (got[1]["tags"], got[1]["name"], got[1]["status"], got[1]["category"]) == (["x"], "u2", "failed", "other")


def test_slugs_scalars_and_file_trees(spark, tmp_path):
    path = write(tmp_path / "m.json", {
        "red_brick": {"name": "Red Brick", "tags": ["wall"], "categories": {"brick": 1, "wall": 2}},
        "plain": {"categories": ["floor"]},
    })
    got = {r["id"]: r for r in S.slug_records(S.read_listing_map(spark, path), "1k").collect()}
    assert (got["red_brick"]["category"], got["plain"]["name"]) == ("ceramic", "plain")
    path = write(tmp_path / "s.json", [
        {"name": "Gold Leaf", "category": ["Metal"], "color": [1.059, 0.773, 0.307], "roughness": 0.1},
        {"name": "Ice", "category": "Organic", "ior": 1.31},
    ])
    got = {r["id"]: r for r in S.scalar_records(S.read_scalar_materials(spark, path)).collect()}
    assert (got["gold_leaf"]["category"], got["gold_leaf"]["color_hex"]) == ("metal", "#10EC54E")
    assert (got["ice"]["category"], got["ice"]["ior"], got["ice"]["maps"]) == ("organic", 1.31, [])
    (tmp_path / "t").mkdir()
    write(tmp_path / "t" / "brick.json", {
        "nor_gl": {"1k": {"jpg": {"url": "j"}, "png": {"url": "n", "size": 5}}},
        "nor_dx": {"1k": {"png": {"url": "later"}}}, "Rough": {"1k": {"png": {"size": 5}, "jpg": {"url": "r"}}},
        "Diffuse": {"2k": {"png": {"url": "d2"}}}, "AO": {"1k": {"exr": {"url": "e"}, "jpg": {"url": "a"}}},
        "blend": {"1k": {"blend": {"url": "b"}}}, "note": "text",
    })
    tree = S.read_asset_files(spark, str(tmp_path / "t"))
    got = {r["channel"]: r["url"] for r in S.map_urls(tree, "slug", "128").collect()}
    assert got == {"normal": "n", "ao": "a"}


def test_documents(spark, tmp_path):
    (tmp_path / "Metal063").mkdir()
    (tmp_path / "Metal063" / "material.mtlx").write_text("<a/>")
    (tmp_path / "Other.mtlx").write_text("<b/>\n<c/>")
    (tmp_path / "x.txt").write_text("no")
    got = {r["id"]: r["xml"] for r in B.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"Metal063": "<a/>", "Other": "<b/>\n<c/>"}


INDEX = [
    ("a1", "ambientcg", "One", "metal", ["1k"], ["color"], None, None, "#A0522D", "ok"),
    ("a2", "ambientcg", "Two", "metal", ["2k", "1k"], [], 0.5, 1.0, None, "ok"),
    ("a3", "ambientcg", "Three", "wood", ["1k"], [], None, None, None, "failed"),
    ("gold", "physicallybased", "Gold", "metal", [], [], 0.125, 1.0, "#FFC54E", "ok"),
]
INDEX_SCHEMA = (
    "id string, source string, name string, category string, available_tiers array<string>, "
    "maps array<string>, roughness double, metalness double, color_hex string, status string"
)


def index(spark):
    df = spark.createDataFrame(INDEX, INDEX_SCHEMA)
    return df.withColumns({"ior": F.lit(1.5), "source_url": F.lit("u"), "source_license": F.lit("l")})


def test_catalog(spark, tmp_path):
    files = spark.createDataFrame([("ambientcg", "1k"), ("ambientcg", "2k")], "source string, tier string")
    thumbs = spark.createDataFrame([("ambientcg", "a1", "color")], "source string, id string, channel string")
    doc = G.catalog(index(spark), files, thumbs, "v2026.04.0", "2026-04-18")
    lines = [r["line"] for r in doc.collect()]
    assert "> **4** materials across **2** sources, **2** resolution tiers." in lines
    at = lines.index("## 🪨 ambientcg")
    assert lines[at + 2] == "> 2 materials | Tiers: 1k, 2k | License: CC0-1.0"
    assert lines[at + 5] == "<details><summary><b>metal</b> (2)</summary>"
    assert lines[at + 9 : at + 11] == [
        "| ![color](../mtlx/ambientcg/a1/color_thumb.png) | [One](https://ambientcg.com/a/a1) | color | metal |",
        "| — | [Two](https://ambientcg.com/a/a2) |  | metal |",
    ]
    assert not any("Three" in x for x in lines)
    assert "| Gold | `#FFC54E` | 0.12 | 1.0 | 1.50 |" in lines
    G.write_catalog(doc, str(tmp_path / "doc"))
    text = [r["value"] for r in spark.read.text(str(tmp_path / "doc")).collect()]
    assert sorted(text) == sorted(lines)


def test_index_round_trip_and_fallback(spark, tmp_path):
    path = str(tmp_path / "index")
    O.write_index(P.index_projection(index(spark)), path)
    back = M.read_index(spark, path, multi_line=False)
    got = {r["id"]: r for r in back.collect()}
    assert got["a3"]["status"] == "failed" and got["a1"]["status"] is None
    assert got["gold"]["roughness"] == 0.125 and got["a2"]["available_tiers"] == ["2k", "1k"]
    raw = "".join(p.read_text() for p in (tmp_path / "index").rglob("part-*"))
    assert "null" not in raw and "texture_hashes" not in raw
    array = write(tmp_path / "array.json", [json.loads(x) for x in raw.splitlines()])
    assert M.read_index(spark, array).count() == 4
    older = index(spark).withColumn("name", F.lit("old"))
    primary = index(spark).filter("source = 'ambientcg'")
    rows = M.with_fallback(primary, older).collect()
    assert sorted((r["id"], r["name"]) for r in rows) == [
        ("a1", "One"), ("a2", "Two"), ("a3", "Three"), ("gold", "old"),
    ]


def test_scalars_fill_only_what_no_texture_gives(spark):
    df = spark.createDataFrame([("gold", "physicallybased", ["roughness"])],
                               "id string, source string, maps array<string>")
    row = L.fill_scalars(df, index(spark)).first()
    assert (row["roughness"], row["metalness"], row["color_hex"], row["ior"]) == (None, 1.0, "#FFC54E", 1.5)


def test_enrich_defaults(spark):
    df = spark.createDataFrame([("a1", "ambientcg"), ("zz", "ambientcg")], "id string, source string")
    got = {r["id"]: tuple(r)[2:] for r in L.enrich(df, index(spark)).collect()}
    assert got == {"a1": ("One", "metal", "u", "l"), "zz": ("zz", "other", "", "CC0-1.0")}


def test_merge_index_and_physical_tags(spark):
    one = index(spark).withColumn("release_tag", F.lit("v1"))
    two = index(spark).filter("id = 'a1'").withColumns(
        {"release_tag": F.lit("v2"), "name": F.lit("New"), "available_tiers": F.array(F.lit("4k"))}
    )
    got = {r["id"]: r for r in U.merge_index(one.unionByName(two)).collect()}
    assert (got["a1"]["name"], got["a1"]["available_tiers"]) == ("New", ["1k", "4k"])
    tagged = spark.createDataFrame(
        [("s", "1", "Plate", ["Brushed", "6061"]), ("s", "2", "Old Oak", [])],
        "source string, id string, name string, tags array<string>",
    )
    families = spark.createDataFrame([("6061", "aluminum"), ("oak", "wood")], "word string, physical_family string")
    links = U.physical_link(tagged, families, ["brushed", "matte"])
    assert {r["id"]: (r["physical_family"], r["finish"]) for r in links.collect()} == {
        "1": ("aluminum", "brushed"), "2": ("wood", None),
    }
    assert [r["id"] for r in U.resolve_physical(links, "aluminum", "brushed").collect()] == ["1"]


def test_listing_window_and_limits(spark):
    df = spark.createDataFrame([(x,) for x in "dbca"], "id string")
    assert [r[0] for r in P.listing_window(df, ["id"], 1, 2).collect()] == ["b", "c"]
    assert [r[0] for r in P.listing_window(df, ["id"], 2, 0).collect()] == ["c", "d"]
    assert [r[0] for r in P.first_ids(df, 0).collect()] == list("abcd")


def test_listing_pages_end_with_a_short_page(spark, tmp_path):
    import json

    from assetlake.sources import pages as G
    from assetlake.sources.listings import read_listing_pages
    from assetlake.streaming.jobs import to_table

    path = tmp_path / "listing"
    path.mkdir()

    def land(no, ids, name="page-%d.json"):
        (path / (name % no)).write_text(json.dumps({"results": [{"id": i, "label": f"l{i}"} for i in ids]}))

    def batch():
        return sorted(r["id"] for r in G.read_pages(spark, str(path), "results", 2).collect())

    def stream():
        rows = G.stream_pages(spark, str(path), "results", 2)
        to_table(rows, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    land(0, "ab")
    land(2, "ef")  # waits for page 1
    assert batch() == stream() == ["a", "b"]
    land(1, "cd", "%d.json")
    assert batch() == stream() == list("abcdef")
    assert batch() == sorted(r["id"] for r in read_listing_pages(spark, str(path), "results").collect())
    land(3, [])  # an empty page ends the listing
    land(4, "xy")
    assert batch() == stream() == list("abcdef")
