import base64
import json
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions import render as X

CHANNELS = ["color", "normal", "roughness", "metalness"]
SCHEMA = (
    "id string, color_hex string, roughness double, metalness double, ior double, "
    "transmission double, " + ", ".join(f"t_{c} binary" for c in CHANNELS)
)
ROWS = [
    ("Rock064", "#A0522D", 0.8, 0.0, 1.5, None, bytearray(b"c" * 90), bytearray(b"n"), None, None),
    ("bare", None, None, None, None, 0.25, None, None, None, None),
    ('we"ird & <id>', None, 0.3, 1.0, None, None, None, None, bytearray(b"r"), bytearray(b"m")),
]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def scalars():
    return {n: F.col(n) for n in ("color_hex", "roughness", "metalness", "ior", "transmission")}


def textures():
    return {c: F.col(f"t_{c}") for c in CHANNELS}


def uri(data):
    return "data:image/png;base64," + base64.b64encode(data).decode()


def test_threejs(spark):
    got = [json.loads(r[0]) for r in frame(spark).select(X.to_threejs(scalars(), textures())).collect()]
    assert got[0] == {
        "type": "MeshPhysicalMaterial", "metalness": 0.0, "roughness": 0.8, "color": 0xA0522D,
        "ior": 1.5, "map": uri(b"c" * 90), "normalMap": uri(b"n"),
    }
    assert got[1] == {"type": "MeshPhysicalMaterial", "transmission": 0.25}


def test_gltf(spark):
    got = [json.loads(r[0]) for r in frame(spark).select(X.to_gltf(scalars(), textures())).collect()]
    assert got[0] == {
        "pbrMetallicRoughness": {
            "metallicFactor": 0.0, "roughnessFactor": 0.8,
            "baseColorFactor": [160 / 255, 82 / 255, 45 / 255, 1.0],
            "baseColorTexture": {"source": {"uri": uri(b"c" * 90)}},
        },
        "extensions": {"KHR_materials_ior": {"ior": 1.5}},
        "normalTexture": {"source": {"uri": uri(b"n")}},
    }
    assert got[1] == {
        "pbrMetallicRoughness": {},
        "extensions": {"KHR_materials_transmission": {"transmissionFactor": 0.25}},
    }
    assert "_note_metallicRoughnessTexture" in got[2]["pbrMetallicRoughness"]


def expected_mtlx(row):
    """The same document made with an XML library."""
    name, present = row["id"], [c for c in CHANNELS if row[f"t_{c}"] is not None]
    root = ET.Element("materialx", version="1.38")
    graph = ET.SubElement(root, "nodegraph", name=f"{name}_textures")
    shader = ET.Element("UsdPreviewSurface", name=f"{name}_shader", type="surfaceshader")
    usd = {r[0]: (r[4], r[5]) for r in S.CHANNEL_REGISTRY}
    links = []
    for c in present:
        prop, kind = usd[c]
        image = ET.SubElement(graph, "image", name=f"img_{c}", type=kind)
        file = ET.SubElement(image, "input", name="file", type="filename", value=f"{name}/{c}.png")
        if c == "color":
            file.set("colorspace", "srgb_texture")
        node = f"img_{c}"
        if c == "normal":
            node = "normalmap_normal"
            nmap = ET.SubElement(graph, "normalmap", name=node, type="vector3")
            ET.SubElement(nmap, "input", name="in", type="vector3", nodename="img_normal")
        ET.SubElement(graph, "output", name=f"out_{c}", type=kind, nodename=node)
        links.append({"name": prop, "type": kind, "nodegraph": f"{name}_textures", "output": f"out_{c}"})
    for scalar, prop in (("roughness", "roughness"), ("metalness", "metallic"), ("ior", "ior")):
        if row[scalar] is not None and scalar not in present:
            ET.SubElement(shader, "input", name=prop, type="float", value=str(row[scalar]))
    for link in links:
        ET.SubElement(shader, "input", link)
    root.append(shader)
    surface = ET.SubElement(root, "surfacematerial", name=name, type="material")
    ET.SubElement(surface, "input", name="surfaceshader", type="surfaceshader", nodename=f"{name}_shader")
    ET.indent(root, space="  ")
    return "<?xml version='1.0' encoding='utf-8'?>\n" + ET.tostring(root, encoding="unicode")


def test_mtlx_equals_the_document_of_an_xml_library(spark):
    files = {
        c: F.when(F.col(f"t_{c}").isNotNull(), F.concat("id", F.lit(f"/{c}.png"))) for c in CHANNELS
    }
    out = frame(spark).withColumn("xml", X.to_mtlx("id", scalars(), files)).collect()
    for row in out:
        assert row["xml"] == expected_mtlx(row)


def test_rewrite_texture_paths(spark):
    xml = (
        '<a value="tex/BaseColor.png"/><b VALUE="Wood-Normal GL.JPG"/><c value="note.txt"/>'
        '<d value="Metallic.tif"/><e value="Height_1.exr"/><f value="odd.png"/>'
    )
    df = spark.createDataFrame([(xml, ["color", "normal"], ["metalness"]), ("<x/>", [], [])],
                               "xml string, ch array<string>, there array<string>")
    got = df.select(
        X.rewrite_texture_paths("xml", "ch", F.lit("/t/M")),
        X.rewrite_texture_paths("xml", "ch", F.lit("/t/M"), "there"),
    ).collect()
    assert got[0][0] == (
        '<a value="/t/M/color.png"/><b value="/t/M/normal.png"/><c value="note.txt"/>'
        '<d value="Metallic.tif"/><e value="Height_1.exr"/><f value="odd.png"/>'
    )
    assert '<d value="/t/M/metalness.png"/>' in got[0][1]
    assert got[1][0] == "<x/>"


def test_attribute_comment(spark):
    df = spark.createDataFrame([('<?xml version="1.0"?><m/>',), ("<m/>",)], "x string")
    got = df.select(X.attribute_comment("x", F.lit("Id"), F.lit("u"), F.lit("CC0-1.0"), "me")).collect()
    lines = (
        "<!-- source: u -->\n<!-- license: CC0-1.0 -->\n<!-- material: Id -->\n<!-- fetched-by: me -->\n"
    )
    assert got[0][0] == '<?xml version="1.0"?>\n' + lines + "<m/>"
    assert got[1][0] == lines + "<m/>"


def test_cells(spark):
    df = spark.createDataFrame([("gpuopen", "x1", "Name", None), ("other", "x2", None, 1.45)],
                               "s string, i string, n string, v double")
    got = df.select(X.material_link("s", "i", "n"), X.fmt_scalar("v", 2), X.color_cell(F.lit(""))).collect()
    assert tuple(got[0]) == (
        "[Name](https://matlib.gpuopen.com/main/materials/all?material=x1)", "—", "—",
    )
    assert tuple(got[1])[:2] == ("[x2](#)", f"{1.45:.2f}")
