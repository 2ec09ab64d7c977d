"""JSON Schema documents compiled to column expressions.

A schema is turned into one array of (subject, rule) per row: ``rule`` names the property and the keyword
that is broken, such as ``maps[].enum`` or ``tiers.*.base_url.required``, ``subject`` the keys and
positions that lead to it, joined by slashes. The rules are plain column functions on typed columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keywords that assert nothing here; formats other than ``date`` are annotations as well.
ANNOTATIONS = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples", "format"}
ASSERTIONS = {
    "$ref", "type", "const", "enum", "anyOf", "required", "properties", "additionalProperties", "propertyNames",
    "minProperties", "maxProperties", "items", "minItems", "maxItems", "uniqueItems", "minLength", "maxLength",
    "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
}

TYPES = {
    "string": T.StringType,
    "integer": T.NumericType,
    "number": T.NumericType,
    "boolean": T.BooleanType,
    "array": T.ArrayType,
    "object": (T.StructType, T.MapType),
    "null": T.NullType,
}

Rename = Callable[[str], str]


class SchemaError(ValueError):
    """A schema that cannot be compiled for the columns it is meant for."""


def load_schema(path: str) -> dict:
    """The schema document at ``path``."""
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(inner) as f:
        return json.loads(f.read())


def breaches(schema: dict, columns: T.StructType, rename: Rename = lambda rule: rule) -> Column:
    """array<struct<subject, rule>> of the rules that a row with ``columns`` breaks, empty if there is none.

    The row is the object that ``schema`` describes, or an item of the array it describes. A null is an absent
    property: it breaks ``required`` and nothing else. A null value of a map or an array breaks what its
    properties require. A keyword that is not known raises, so no rule is left out unseen.
    """
    node = _resolved(schema, schema)
    if node.get("type") == "array":
        node = _resolved(node["items"], schema)
    row = F.struct(*[F.col(f"`{f.name}`").alias(f.name) for f in columns.fields])
    return _all(_Compiler(schema, rename).node(node, columns, row, None, ""))


def violations(df: DataFrame, schema: dict, keys: list[str], rename: Rename = lambda rule: rule) -> DataFrame:
    """(keys, subject, rule), one row per subject and broken rule."""
    # Texts, as only of these array_distinct keeps a hash set; structs it compares each with each.
    text = F.transform(breaches(schema, df.schema, rename), lambda b: F.concat(b["rule"], F.lit("\0"), b["subject"]))
    rule = F.substring_index("b", "\0", 1)
    subject = F.substr("b", F.length(rule) + 2)
    found = df.select(*keys, F.explode(F.array_distinct(text)).alias("b"))
    return found.select(*keys, subject.alias("subject"), rule.alias("rule"))


def _resolved(node: dict, root: dict) -> dict:
    while "$ref" in node:
        ref = node["$ref"]
        if not ref.startswith("#/"):
            raise SchemaError(f"only references into the same document are followed, not {ref}")
        found = root
        for step in ref[2:].split("/"):
            found = found[step]
        node = {**found, **{k: v for k, v in node.items() if k != "$ref"}}
    return node


def _all(found: list[Column]) -> Column:
    """The arrays of ``found`` as one; a null stands for an empty one."""
    empty = F.array().cast("array<struct<subject: string, rule: string>>")
    return F.flatten(F.array_compact(F.array(empty, *found)))


def _below(subject: Column | None, key: Column) -> Column:
    return key if subject is None else F.concat(subject, F.lit("/"), key)


def _is_date(x: Column) -> Column:
    return x.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(x).isNotNull()


class _Compiler:
    def __init__(self, root: dict, rename: Rename):
        self.root, self.rename = root, rename

    def node(self, node: dict, dtype: T.DataType, x: Column, subject: Column | None, at: str) -> list[Column]:
        """Arrays of breaches of ``x``, each null if its rule holds."""
        node = _resolved(node, self.root)
        unknown = set(node) - ANNOTATIONS - ASSERTIONS
        if unknown:
            raise SchemaError(f"{at or 'the schema'}: no rule for {sorted(unknown)}")
        out: list[Column] = []

        def rule(keyword: str, bad: Column) -> None:
            out.append(self.breach(bad, subject, f"{at}.{keyword}" if at else keyword))

        self.check_type(node, dtype, at)
        if "const" in node:
            rule("const", x != F.lit(node["const"]))
        if "enum" in node:
            rule("enum", ~x.isin([v for v in node["enum"] if v is not None]))
        if "anyOf" in node:
            broken = [F.size(_all(self.node(n, dtype, x, subject, at))) > 0 for n in node["anyOf"]]
            rule("anyOf", F.array_min(F.array(*broken)))
        if isinstance(dtype, T.StringType):
            self.text(node, x, rule)
        elif isinstance(dtype, T.NumericType):
            self.number(node, dtype, x, rule)
        elif isinstance(dtype, T.ArrayType):
            out += self.array(node, dtype, x, subject, at, rule)
        elif isinstance(dtype, T.MapType):
            out += self.mapping(node, dtype, x, subject, at, rule)
        elif isinstance(dtype, T.StructType):
            out += self.struct(node, dtype, x, subject, at)
        return out

    def breach(self, bad: Column, subject: Column | None, name: str) -> Column:
        where = F.lit("") if subject is None else subject
        one = F.struct(where.alias("subject"), F.lit(self.rename(name)).alias("rule"))
        return F.when(bad, F.array(one))

    @staticmethod
    def check_type(node: dict, dtype: T.DataType, at: str) -> None:
        names = node.get("type", [])
        names = [names] if isinstance(names, str) else names
        if names and not any(isinstance(dtype, TYPES[n]) for n in names):
            raise SchemaError(f"{at or 'the row'} is {dtype.simpleString()}, the schema says {' or '.join(names)}")

    @staticmethod
    def text(node: dict, x: Column, rule: Callable[[str, Column], None]) -> None:
        if node.get("minLength", 0) > 0:
            rule("minLength", F.length(x) < node["minLength"])
        if "maxLength" in node:
            rule("maxLength", F.length(x) > node["maxLength"])
        if "pattern" in node:
            rule("pattern", ~x.rlike(node["pattern"]))
        if node.get("format") == "date":
            rule("format", ~_is_date(x))

    @staticmethod
    def number(node: dict, dtype: T.DataType, x: Column, rule: Callable[[str, Column], None]) -> None:
        whole = node.get("type") == "integer" and not isinstance(dtype, T.IntegralType)
        if whole:
            rule("type", x != F.floor(x))
        if "minimum" in node:
            rule("minimum", x < node["minimum"])
        if "maximum" in node:
            rule("maximum", x > node["maximum"])
        if "exclusiveMinimum" in node:
            rule("exclusiveMinimum", x <= node["exclusiveMinimum"])
        if "exclusiveMaximum" in node:
            rule("exclusiveMaximum", x >= node["exclusiveMaximum"])

    def array(self, node, dtype, x, subject, at, rule) -> list[Column]:
        if node.get("minItems", 0) > 0:
            rule("minItems", F.size(x) < node["minItems"])
        if "maxItems" in node:
            rule("maxItems", F.size(x) > node["maxItems"])
        if node.get("uniqueItems"):
            rule("uniqueItems", F.size(F.array_distinct(x)) < F.size(x))

        def each(item: Column, i: Column) -> Column:
            return _all(self.node(node["items"], dtype.elementType, item, _below(subject, i.cast("string")), f"{at}[]"))

        return [F.flatten(F.transform(x, each))] if self.asserts(node.get("items")) else []

    def mapping(self, node, dtype, x, subject, at, rule) -> list[Column]:
        if node.get("minProperties", 0) > 0:
            rule("minProperties", F.size(x) < node["minProperties"])
        if "maxProperties" in node:
            rule("maxProperties", F.size(x) > node["maxProperties"])
        names, values = node.get("propertyNames"), node.get("additionalProperties")
        known = node.get("properties", {})
        if known or node.get("required"):
            raise SchemaError(f"{at or 'the row'} is a map: its keys cannot be named properties")

        def each(entry: Column) -> Column:
            at_key, found = _below(subject, entry["key"]), []
            if self.asserts(names):
                found += self.node(names, dtype.keyType, entry["key"], at_key, f"{at}.propertyNames")
            if self.asserts(values):
                found += self.node(values, dtype.valueType, entry["value"], at_key, f"{at}.*")
            return _all(found)

        if not (self.asserts(names) or self.asserts(values)):
            return []
        return [F.flatten(F.transform(F.map_entries(x), each))]

    def struct(self, node, dtype, x, subject, at) -> list[Column]:
        """Rules of the properties. An absent struct is told apart by its parent, which does not come here."""
        have = {f.name: f.dataType for f in dtype.fields}
        out = []
        for name in node.get("required", []):
            lacking = x[name].isNull() if name in have else F.lit(True)
            out.append(self.breach(lacking, subject, f"{at}.{name}.required".lstrip(".")))
        for name, sub in node.get("properties", {}).items():
            if name not in have:
                continue
            inner = self.node(sub, have[name], x[name], subject, f"{at}.{name}".lstrip("."))
            if isinstance(have[name], T.StructType) and inner:
                inner = [F.when(x[name].isNotNull(), _all(inner))]
            out += inner
        if node.get("additionalProperties") is False:
            for name in have.keys() - node.get("properties", {}).keys():
                out.append(self.breach(x[name].isNotNull(), subject, f"{at}.{name}.additionalProperties".lstrip(".")))
        return out

    def asserts(self, node) -> bool:
        return isinstance(node, dict) and bool(set(_resolved(node, self.root)) & (ASSERTIONS | {"format"}))
