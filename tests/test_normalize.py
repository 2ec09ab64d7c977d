import pytest
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import names as A
from assetlake.functions import normalize as N
from assetlake.functions import payload as B
from assetlake.operators import lookup as L


def values(spark, rows, schema, **cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in cols.items()]).collect()]


def test_categories(spark):
    pairs = [
        ("Metal/Steel", "metal"), ("Stone/Marble/White", "stone"), ("CONCRETE", "concrete"),
        ("Soil", "organic"), ("", "other"), (None, "other"), ("Bricks104", "other"),
        ("  Old  Oak /x", "wood"), ("bark", "organic"), ("dark rusty wood", "metal"),
        ("fine-wood", "other"), ("/metal", "other"),
    ]
    got = values(spark, [(p,) for p, _ in pairs], "raw string", c=N.normalize_category("raw"))
    assert [g[0] for g in got] == [want for _, want in pairs]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pairs)], "k int, raw string")
    by_join = L.map_category(df, S.keywords_df(spark), "k").collect()
    assert {r["k"]: r["category"] for r in by_join} == {i: w for i, (_, w) in enumerate(pairs)}


def test_channels(spark):
    rows = [
        ("ambientcg", "NormalGL", "normal"), ("ambientcg", "AmbientOcclusion", "ao"),
        ("polyhaven", "nor_gl", "normal"), ("polyhaven", "Diffuse", "color"),
        ("gpuopen", "Base_Color", "color"), ("ambientcg", "Opacity", None),
        ("polyhaven", "arm", None), ("ambientcg", "unknown", None), ("elsewhere", "color", None),
    ]
    got = values(spark, rows, "s string, raw string, want string",
                 c=N.normalize_channel(F.col("s"), "raw"))
    assert [g[0] for g in got] == [r[2] for r in rows]


def test_member_names(spark):
    rows = [
        ("Rock064_1K_NormalGL.png",), ("a/b_Color.JPG",), ("Color.png",), ("x_Color.tif",),
        ("x_Color.png.txt",),
    ]
    got = values(spark, rows, "n string", c=N.channel_from_member("n"))
    assert [g[0] for g in got] == ["NormalGL", "Color", None, None, None]
    rows = [
        ("tex/Wood_basecolor.png",), ("normal.exr",), ("x_roughness_2k.TIFF",),
        ("color_normal-v2.png",), ("roughness.txt",), ("my.color.png",), ("_height_.jpeg",),
    ]
    got = values(spark, rows, "n string", c=N.channel_from_tokens("n"))
    assert [g[0] for g in got] == [
        "color", "normal", "roughness", "normal", None, None, "displacement",
    ]


def test_first_category_and_tags(spark):
    rows = [
        ('{"wall": 1, "brick": 2}',), ('["floor", "tile"]',), ("[]",), ("{}",), ("Metal",),
        ('"Glass"',), (None,),
    ]
    got = values(spark, rows, "j string", c=N.first_category("j"))
    assert [g[0] for g in got] == ["wall", "floor", "", "", "Metal", "Glass", ""]
    got = values(spark, [(" a, ,b ,c d,",), ('["x", "y"]',), (None,)], "t string",
                 c=N.tags_of_json("t"))
    assert [g[0] for g in got] == [["a", "b", "c d"], ["x", "y"], []]


def test_colors(spark):
    rows = [([0.0, 0.5, 1.0],), ([1.059, 0.773, 0.307],), ([0.1],), (None,)]
    got = values(spark, rows, "c array<double>", h=N.rgb_to_hex("c"), k=N.rgb_to_hex("c", True))
    assert got[0] == ("#0080FF", "#0080FF")
    assert got[1] == ("#10EC54E", "#FFC54E")
    assert got[2:] == [(None, None)] * 2
    got = values(spark, [("#A0522D",), ("zz",), (None,)], "c string",
                 i=N.hex_to_int("c"), r=N.hex_to_rgba("c"))
    assert got[0][0] == 10506797
    assert got[0][1] == [160 / 255, 82 / 255, 45 / 255, 1.0]
    assert got[1][0] is None and got[2] == (None, None)


def test_sizes(spark):
    texts = [("5GB",), ("500 MB",), ("0",), ("",), ("12",), ("1.5kb",), ("7B",), ("many",), ("xMB",)]
    got = [g[0] for g in values(spark, texts, "t string", n=B.parse_size("t"))]
    assert got == [5 * 1024**3, 500 * 1024**2, 0, 0, 12, 1536, 7, None, None]
    nums = [(0,), (1023,), (1024,), (1536,), (5 * 1024**3,), (2 * 1024**5,)]
    got = [g[0] for g in values(spark, nums, "n bigint", t=B.fmt_size("n"))]
    assert got == ["0 B", "1023 B", "1.0 KB", "1.5 KB", "5.0 GB", "2.0 PB"]


@pytest.mark.parametrize("x", [0.125, 0.145, 0.675, 0.665, 1.005, 2.5, 1.333, 0.0, 1234567.895])
def test_decimals_round_like_the_exact_binary_value(spark, x):
    got = values(spark, [(x,)], "x double", a=B.fmt_decimal("x", 2), b=B.fmt_decimal("x", 1))
    assert got == [(f"{x:.2f}", f"{x:.1f}")]


def test_asset_names(spark):
    rows = [
        ("assetlake-ambientcg-1k-metal.parquet",), ("assetlake-ambientcg-ktx2-128-other-7.parquet",),
        ("polyhaven-mtlx-original-wood-rowmap.json",), ("assetlake-a-1k-velvet.parquet",),
        ("assetlake-a-1k-metal.parquet.part",), ("x-a-1k-metal.parquet",),
    ]
    got = [g[0] for g in values(spark, rows, "n string", p=A.parse_asset_name("n"))]
    assert tuple(got[0]) == ("bundle", "ambientcg", "1k", "metal", None, None)
    assert tuple(got[1]) == ("bundle", "ambientcg", "ktx2-128", "other", 7, None)
    assert tuple(got[2]) == ("rowmap", "polyhaven", "mtlx-original", "wood", None, None)
    assert got[3:] == [None] * 3
    got = values(spark, [("s", "1k", "metal", 1), ("s", "1k", "metal", 3)],
                 "s string, t string, c string, n int",
                 plain=A.asset_name("s", "t", "c", "n"),
                 first=A.asset_name("s", "t", "c", "n", first_unnumbered=True),
                 rm=A.rowmap_name(A.asset_name("s", "t", "c", "n")))
    assert got[0] == ("assetlake-s-1k-metal-1.parquet", "assetlake-s-1k-metal.parquet",
                      "s-1k-metal-1-rowmap.json")
    assert got[1][1] == "assetlake-s-1k-metal-3.parquet"


def test_release_tags(spark):
    rows = [("v2026.04.0",), ("v2026.4.0",), ("2026.04.0",), ("v2026.12.11",), (None,)]
    got = values(spark, rows, "t string", ok=N.release_tag_ok("t"))
    assert [g[0] for g in got] == [True, False, False, True, False]


def test_magic_and_dimensions(spark):
    png = S.PNG_MAGIC + b"\r\n\x1a\n\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (7).to_bytes(4, "big")
    rows = [(bytearray(png),), (bytearray(S.KTX2_MAGIC + b"x"),), (bytearray(b"\x89P"),), (None,)]
    got = values(spark, rows, "p binary", png=B.png_ok("p"), ktx=B.ktx2_ok("p"),
                 dim=B.png_dimensions("p"))
    assert [g[0] for g in got] == [True, False, False, False]
    assert [g[1] for g in got] == [False, True, False, False]
    assert tuple(got[0][2]) == (640, 7) and got[1][2] is None
