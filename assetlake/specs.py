"""JSON Schema documents of the index, the rowmaps and the manifest, made of the lists in ``schemas``."""

from __future__ import annotations

import json

import pyarrow.fs as pafs

from assetlake import schemas as S

DRAFT = "https://json-schema.org/draft/2020-12/schema"


def _text(**more) -> dict:
    return {"type": "string", **more}


def _list(items: dict, **more) -> dict:
    return {"type": "array", "items": items, **more}


def _object(properties: dict, required: list[str], **more) -> dict:
    return {"type": "object", "required": required, "properties": properties, **more}


def _keyed(values: dict, **more) -> dict:
    return {"type": "object", "additionalProperties": values, **more}


def index_schema(sources: list[str] | None = None, categories: list[str] | None = None) -> dict:
    """Entries of an index file."""
    named, unit = _text(minLength=1), {"type": ["number", "null"], "minimum": 0.0, "maximum": 1.0}
    digest = _object(
        {"sha256": _text(pattern=S.SHA256_PATTERN), "size": {"type": "integer", "minimum": 1}}, ["sha256", "size"]
    )
    entry = _object(
        {
            "id": named,
            "source": _text(enum=sources or S.SOURCES),
            "name": named,
            "category": _text(enum=categories or S.CATEGORIES),
            "tags": _list(_text()),
            "color_hex": {"type": ["string", "null"], "pattern": S.COLOR_PATTERN},
            "roughness": unit,
            "metalness": unit,
            "ior": {"type": ["number", "null"], "minimum": 0.0},
            "source_url": _text(format="uri"),
            "source_license": named,
            "available_tiers": _list(_text(pattern=S.TIER_PATTERN), uniqueItems=True),
            "maps": _list(_text(enum=S.CHANNELS), uniqueItems=True),
            "last_updated": _text(format="date"),
            "texture_hashes": _keyed(digest, propertyNames={"enum": S.CHANNELS}),
            "status": _text(enum=["ok", "failed"]),
        },
        S.INDEX_REQUIRED,
    )
    return {"$schema": DRAFT, "title": "index", "type": "array", "items": entry}


def rowmap_schema(sources: list[str] | None = None) -> dict:
    """The rowmap of one bundle."""
    place = _object(
        {"offset": {"type": "integer", "minimum": 0}, "length": {"type": "integer", "minimum": 1}}, ["offset", "length"]
    )
    material = _keyed({"$ref": "#/$defs/place"}, propertyNames={"enum": S.CHANNELS}, minProperties=1)
    document = _object(
        {
            "version": {"type": "integer", "const": 1},
            "release_tag": _text(pattern=S.RELEASE_TAG_PATTERN),
            "source": _text(enum=sources or S.SOURCES),
            "tier": _text(),
            "parquet_file": _text(),
            "materials": _keyed({"$ref": "#/$defs/material"}),
        },
        ["version", "release_tag", "source", "tier", "parquet_file", "materials"],
    )
    return {"$schema": DRAFT, "title": "rowmap", **document, "$defs": {"material": material, "place": place}}


def manifest_schema(known: tuple[int, ...] = (1,)) -> dict:
    """The manifest of a release; a source has one rowmap or a list of them."""
    some = {"minItems": 1}
    source = _object({"parquet_files": _list(_text(), **some)}, ["parquet_files"])
    source["anyOf"] = [
        {"required": ["rowmap_file"]},
        {"required": ["rowmap_files"], "properties": {"rowmap_files": some}},
    ]
    tier = _object({"base_url": _text(minLength=1), "sources": _keyed(source, minProperties=1)}, ["base_url", "sources"])
    document = _object(
        {
            "schema_version": {"type": "integer", "enum": list(known)},
            "release_tag": _text(pattern=S.RELEASE_TAG_PATTERN),
            "tiers": _keyed(tier),
        },
        ["schema_version", "release_tag", "tiers"],
    )
    return {"$schema": DRAFT, "title": "manifest", **document}


def write_schemas(root: str) -> None:
    """``<root>/<title>-schema.json`` of the three documents."""
    fs, inner = pafs.FileSystem.from_uri(root)
    fs.create_dir(inner, recursive=True)
    for schema in (index_schema(), rowmap_schema(), manifest_schema()):
        with fs.open_output_stream(f"{inner}/{schema['title']}-schema.json") as out:
            out.write(json.dumps(schema, indent=2).encode())
