"""Renderer exports and markup, built as string and struct expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake import schemas as S
from assetlake.functions.normalize import _c, hex_to_int, hex_to_rgba, upstream_url
from assetlake.functions.payload import data_uri, fmt_decimal

# Fixed values of the export formats.
PACKING_NOTE = (
    "Separate metalness and roughness textures provided. "
    "Pack into a single metallicRoughnessTexture (B=metal, G=rough) "
    "for full glTF compliance."
)
GLTF_ON_MATERIAL = {"normalTexture", "occlusionTexture", "emissiveTexture"}
SRGB_CHANNELS = {"color", "emission"}

Columns = dict[str, Column]


def _scalar(scalars: Columns, name: str) -> Column:
    return scalars[name] if name in scalars else F.lit(None)


def _uri(textures: Columns, channel: str) -> Column | None:
    if channel not in textures:
        return None
    return F.when(textures[channel].isNotNull(), data_uri(textures[channel]))


def to_threejs(scalars: Columns, textures: Columns) -> Column:
    """JSON parameters of a physical three.js material; absent values are left out."""
    fields = [F.lit("MeshPhysicalMaterial").alias("type")]
    for name in ("metalness", "roughness"):
        fields.append(_scalar(scalars, name).cast("double").alias(name))
    fields.append(hex_to_int(_scalar(scalars, "color_hex").cast("string")).alias("color"))
    for name in ("ior", "transmission"):
        fields.append(_scalar(scalars, name).cast("double").alias(name))
    for channel, slot, *_ in S.CHANNEL_REGISTRY:
        uri = _uri(textures, channel)
        if uri is not None:
            fields.append(uri.alias(slot))
    return F.to_json(F.struct(*fields))


def to_gltf(scalars: Columns, textures: Columns) -> Column:
    """JSON of a glTF material: factors, extensions and one entry per texture slot."""
    pbr = [
        _scalar(scalars, "metalness").cast("double").alias("metallicFactor"),
        _scalar(scalars, "roughness").cast("double").alias("roughnessFactor"),
        hex_to_rgba(_scalar(scalars, "color_hex").cast("string")).alias("baseColorFactor"),
    ]
    outer = []
    for channel, _, slot, *_ in S.CHANNEL_REGISTRY:
        uri = _uri(textures, channel) if slot else None
        if uri is None:
            continue
        ref = F.when(uri.isNotNull(), F.struct(F.struct(uri.alias("uri")).alias("source")))
        (outer if slot in GLTF_ON_MATERIAL else pbr).append(ref.alias(slot))
    if "metalness" in textures and "roughness" in textures:
        both = textures["metalness"].isNotNull() & textures["roughness"].isNotNull()
        pbr.append(F.when(both, F.lit(PACKING_NOTE)).alias("_note_metallicRoughnessTexture"))

    ior = _scalar(scalars, "ior").cast("double")
    transmission = _scalar(scalars, "transmission").cast("double")
    extensions = F.when(
        ior.isNotNull() | transmission.isNotNull(),
        F.struct(
            F.when(ior.isNotNull(), F.struct(ior.alias("ior"))).alias("KHR_materials_ior"),
            F.when(
                transmission.isNotNull(), F.struct(transmission.alias("transmissionFactor"))
            ).alias("KHR_materials_transmission"),
        ),
    )
    return F.to_json(
        F.struct(
            F.struct(*pbr).alias("pbrMetallicRoughness"), extensions.alias("extensions"), *outer
        )
    )


XML_ESCAPES = [
    ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
    ("\r", "&#13;"), ("\n", "&#10;"), ("\t", "&#09;"),
]


def xml_attr(x: Column | str) -> Column:
    return reduce(
        lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), XML_ESCAPES, _c(x).cast("string")
    )


def _text(template: str, **values: Column) -> Column:
    """String expression of a template whose ``{name}`` holes are filled with columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(values[name])
    return F.concat(*parts)


def to_mtlx(name: Column | str, scalars: Columns, files: Columns) -> Column:
    """MaterialX 1.38 document of a preview surface.

    ``files`` gives the texture file of a channel, null where the channel is absent. A scalar is
    written only where its texture is absent; the refraction index always.
    """
    name = xml_attr(name)
    images, links = [], []
    for channel, _, _, _, usd, usd_type, _ in S.CHANNEL_REGISTRY:
        if channel not in files:
            continue
        space = ' colorspace="srgb_texture"' if channel in SRGB_CHANNELS else ""
        out_type, node = usd_type, f"img_{channel}"
        extra = ""
        if channel == "normal":
            out_type, node = "vector3", f"normalmap_{channel}"
            extra = (
                f'    <normalmap name="{node}" type="vector3">\n'
                f'      <input name="in" type="vector3" nodename="img_{channel}" />\n'
                "    </normalmap>\n"
            )
        image = (
            f'    <image name="img_{channel}" type="{usd_type}">\n'
            '      <input name="file" type="filename" value="{file}"' + space + " />\n"
            "    </image>\n" + extra +
            f'    <output name="out_{channel}" type="{out_type}" nodename="{node}" />\n'
        )
        link = (
            f'    <input name="{usd}" type="{out_type}" '
            'nodegraph="{name}_textures"' + f' output="out_{channel}" />\n'
        )
        there = files[channel].isNotNull()
        images.append(F.when(there, _text(image, file=xml_attr(files[channel]))).otherwise(""))
        links.append(F.when(there, _text(link, name=name)).otherwise(""))

    inputs = []
    for scalar, usd in (("roughness", "roughness"), ("metalness", "metallic"), ("ior", "ior")):
        if scalar not in scalars:
            continue
        wanted = scalars[scalar].isNotNull()
        if scalar != "ior" and scalar in files:
            wanted = wanted & files[scalar].isNull()
        line = f'    <input name="{usd}" type="float" value="' + '{v}" />\n'
        value = scalars[scalar].cast("string")
        inputs.append(F.when(wanted, _text(line, v=value)).otherwise(""))

    def element(tag: str, attrs: str, body: list[Column]) -> Column:
        inner = F.concat(*body) if body else F.lit("")
        start = _text(f"  <{tag} {attrs}", name=name)
        return F.when(inner == "", F.concat(start, F.lit(" />\n"))).otherwise(
            F.concat(start, F.lit(">\n"), inner, F.lit(f"  </{tag}>\n"))
        )

    surface = (
        '  <surfacematerial name="{name}" type="material">\n'
        '    <input name="surfaceshader" type="surfaceshader" nodename="{name}_shader" />\n'
        "  </surfacematerial>\n"
    )
    return F.concat(
        F.lit("<?xml version='1.0' encoding='utf-8'?>\n<materialx version=\"1.38\">\n"),
        element("nodegraph", 'name="{name}_textures"', images),
        element("UsdPreviewSurface", 'name="{name}_shader" type="surfaceshader"', inputs + links),
        _text(surface, name=name),
        F.lit("</materialx>"),
    )


# Fixed pattern of a texture value in a document.
TEXTURE_VALUE = r'(?i)value="([^"]*\.(?:png|jpg|jpeg|tif|tiff|exr))"'


def rewrite_texture_paths(
    xml: Column | str,
    channels: Column | str,
    folder: Column | str,
    existing: Column | str | None = None,
) -> Column:
    """Point texture values of a document at ``<folder>/<channel>.png``.

    The first alias found in the file stem whose channel is present wins; without one, the first
    alias whose file is in ``existing``; otherwise the value stays.
    """
    xml, channels, folder = _c(xml), _c(channels), _c(folder)
    aliases = [
        (alias.replace("_", ""), row[0]) for row in S.CHANNEL_REGISTRY for alias in row[6]
    ]

    def target(value: Column) -> Column:
        base = F.substring_index(value, "/", -1)
        stem = F.translate(F.lower(F.regexp_replace(base, r"\.[^.]*$", "")), " -_", "")

        def first_of(present: Column) -> Column:
            hits = [
                F.when(F.contains(stem, F.lit(a)) & F.array_contains(present, c), F.lit(c))
                for a, c in aliases
            ]
            return F.coalesce(*hits)

        found = first_of(channels)
        if existing is not None:
            found = F.coalesce(found, first_of(_c(existing)))
        return F.concat(F.lit('value="'), folder, F.lit("/"), found, F.lit('.png"'))

    quoted = F.regexp_extract_all(xml, F.lit(TEXTURE_VALUE), F.lit(0))
    values = F.regexp_extract_all(xml, F.lit(TEXTURE_VALUE), F.lit(1))
    gaps = F.split(xml, TEXTURE_VALUE, -1)
    pieces = F.zip_with(
        F.zip_with(quoted, values, lambda q, v: F.struct(q.alias("q"), v.alias("v"))),
        F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(1))),
        lambda m, gap: F.concat(
            F.coalesce(target(m["v"]), m["q"]), F.coalesce(gap, F.lit(""))
        ),
    )
    return F.when(
        F.size(values) > 0, F.concat(F.get(gaps, F.lit(0)), F.array_join(pieces, ""))
    ).otherwise(xml)


def attribute_comment(
    xml: Column | str,
    material_id: Column | str,
    url: Column | str,
    license_id: Column | str,
    fetched_by: str = "assetlake",
) -> Column:
    """Four comment lines after the XML declaration, or in front when there is none."""
    xml = _c(xml)
    comment = F.concat(
        F.lit("<!-- source: "), _c(url), F.lit(" -->\n<!-- license: "), _c(license_id),
        F.lit(" -->\n<!-- material: "), _c(material_id),
        F.lit(f" -->\n<!-- fetched-by: {fetched_by} -->\n"),
    )
    end = F.locate("?>", xml)
    declared = F.startswith(xml, F.lit("<?xml")) & (end > 0)
    return F.when(
        declared,
        F.concat(
            F.substr(xml, F.lit(1), end + 1), F.lit("\n"), comment, F.substr(xml, end + 2)
        ),
    ).otherwise(F.concat(comment, xml))


DASH = "—"


def fmt_scalar(x: Column | str, digits: int) -> Column:
    return F.coalesce(fmt_decimal(x, digits), F.lit(DASH))


def color_cell(x: Column | str) -> Column:
    x = F.nullif(_c(x), F.lit(""))
    return F.coalesce(F.concat(F.lit("`"), x, F.lit("`")), F.lit(DASH))


def material_link(source: Column | str, material_id: Column | str, name: Column | str) -> Column:
    url = F.coalesce(upstream_url(source, material_id), F.lit("#"))
    label = F.coalesce(_c(name), _c(material_id))
    return F.concat(F.lit("["), label, F.lit("]("), url, F.lit(")"))


def thumb_img(source: Column | str, material_id: Column | str, channel: str) -> Column:
    return F.concat(
        F.lit(f"![{channel}](../mtlx/"), _c(source), F.lit("/"), _c(material_id),
        F.lit(f"/{channel}_thumb.png)"),
    )
