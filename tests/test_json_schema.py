import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake import schemas as S
from assetlake import specs
from assetlake.functions.json_schema import SchemaError, load_schema, violations
from assetlake.operators import quality as Q

ENTRY = dict(id="x", source="ambientcg", name="n", category="metal", tags=[], source_url="u", source_license="l",
             available_tiers=["1k"], maps=["color"], last_updated="2026-04-18", color_hex=None, roughness=0.5,
             metalness=None, ior=1.5, source_mtlx_url=None, texture_hashes=None, status=None)


def index(spark, *rows):
    return spark.createDataFrame([{**ENTRY, **r} for r in rows], S.INDEX_SCHEMA)


def found(df):
    return {(r["id"], r["rule"]) for r in df.collect()}


def test_rules_come_from_the_schema_file(spark, tmp_path):
    specs.write_schemas(str(tmp_path))
    schema = load_schema(f"{tmp_path}/index-schema.json")
    assert schema == specs.index_schema()
    rows = index(spark, {}, {"id": "late", "last_updated": "2026-02-30"}, {"id": "rough", "roughness": 2.0})
    assert found(Q.check_index(rows, schema=schema)) == {("late", "last_updated_date"), ("rough", "roughness_range")}

    entry = schema["items"]["properties"]
    entry["roughness"]["maximum"] = 3
    entry["name"]["maxLength"] = 3
    entry["tags"] |= {"minItems": 1, "items": {"type": "string", "pattern": "^[a-z]+$"}}
    schema["items"]["required"].append("color_hex")
    (tmp_path / "changed.json").write_text(json.dumps(schema))
    rows = rows.unionByName(index(spark, {"id": "named", "name": "long", "tags": ["ok", "NO"], "color_hex": "#000000"}))
    got = found(Q.check_index(rows, schema=load_schema(f"{tmp_path}/changed.json")))
    assert got == {
        ("named", "name.maxLength"), ("named", "tags[].pattern"), ("late", "last_updated_date"),
        *[(i, r) for i in ("x", "late", "rough") for r in ("tags.minItems", "color_hex.required")],
    }


def test_every_rule_of_the_index(spark):
    digest = {"color": {"sha256": "0" * 64, "size": 1}}
    broken = {
        "missing_name": {"name": None}, "empty_name": {"name": ""}, "source_enum": {"source": "else"},
        "category_enum": {"category": "velvet"}, "color_pattern": {"color_hex": "#12"},
        "metalness_range": {"metalness": float("nan")}, "ior_range": {"ior": -0.1},
        "tier_pattern": {"available_tiers": ["3k"]}, "tiers_unique": {"available_tiers": ["1k", "1k"]},
        "maps_enum": {"maps": ["gloss"]}, "maps_unique": {"maps": ["ao", "ao"]}, "status_enum": {"status": "late"},
        "hash_channel": {"texture_hashes": {"gloss": digest["color"]}},
        "hash_shape": {"texture_hashes": {"ao": {"sha256": "x", "size": 0}, "color": None}},
        "missing_maps": {"maps": None}, "last_updated_date": {"last_updated": ""},
    }
    rows = [{"id": rule, **change} for rule, change in broken.items()]
    fine = {"id": "fine", "texture_hashes": digest, "status": "ok", "color_hex": "#A0522D", "metalness": 1.0}
    got = found(Q.check_index(index(spark, fine, *rows)))
    assert got == {(rule, rule) for rule in broken}
    assert Q.check_index(index(spark).limit(0)).count() == 0


def test_nested_documents_name_the_place(spark):
    place = "struct<offset: bigint, length: bigint>"
    docs = spark.createDataFrame(
        [("f", 1, "v2026.04.0", "ambientcg", "1k", {"a": {"color": (0, 5), "gloss": (0, 0)}, "b": {}, "c": {"ao": None}}),
         ("g", 2, None, "ambientcg", "1k", None)],
        "parquet_file string, version int, release_tag string, source string, tier string, "
        f"materials map<string, map<string, {place}>>",
    )
    assert {tuple(r) for r in Q.check_rowmap_documents(docs).collect()} == {
        ("f", "a/gloss", "channel_enum"), ("f", "a/gloss", "length_range"), ("f", "b", "no_channel"),
        ("f", "c/ao", "offset_range"), ("f", "c/ao", "length_range"),
        ("g", "", "version"), ("g", "", "release_tag_pattern"), ("g", "", "materials.required"),
    }


def test_keywords(spark):
    df = spark.createDataFrame(
        [(1, 0.5, ["a", "bb"], (None,), "x"), (2, 2.0, [], ("deep",), None), (3, None, None, None, None)],
        "id int, n double, l array<string>, s struct<t: string>, extra string",
    )
    schema = {
        "required": ["n"],
        "properties": {
            "id": {"type": "integer", "exclusiveMaximum": 3},
            "n": {"type": "integer", "exclusiveMinimum": 0.5},
            "l": {"type": "array", "maxItems": 1, "items": {"maxLength": 1}},
            "s": {"type": "object", "required": ["t"], "properties": {"t": {"const": "flat"}}},
        },
        "additionalProperties": False,
    }
    assert {tuple(r) for r in violations(df, schema, ["id"]).collect()} == {
        (1, "", "n.type"), (1, "", "n.exclusiveMinimum"), (1, "", "l.maxItems"), (1, "1", "l[].maxLength"),
        (1, "", "s.t.required"), (1, "", "extra.additionalProperties"), (2, "", "s.t.const"),
        (3, "", "id.exclusiveMaximum"), (3, "", "n.required"),
    }
    plan = violations(df, schema, ["id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(
    "schema",
    [{"properties": {"id": {"multipleOf": 2}}}, {"properties": {"id": {"type": "string"}}},
     {"properties": {"id": {"$ref": "other.json#/id"}}}],
)
def test_what_cannot_be_compiled_raises(spark, schema):
    with pytest.raises(SchemaError):
        violations(spark.range(1), schema, ["id"])


def test_types_of_the_columns_fit_the_schemas():
    entry = specs.index_schema()["items"]
    assert set(entry["required"]) <= set(entry["properties"]) <= set(S.INDEX_SCHEMA.names)
    assert entry["properties"]["maps"]["items"]["enum"] == S.CHANNELS
    assert set(specs.rowmap_schema()["properties"]) == set(T.StructType.fromDDL(S.ROWMAP_SCHEMA).names)
