"""JSON Schema (the supported subset) to Spark types."""

from __future__ import annotations

import json

from pyspark.sql import types as T

SCALARS = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
}


# Levels of a schema; a reference that contains itself never ends.
MAX_DEPTH = 32


class InvalidJsonSchema(ValueError):
    """The schema cannot guide an extraction (``INVALID_JSON_SCHEMA``)."""


def load(schema: str | dict) -> dict:
    if isinstance(schema, dict):
        return schema
    try:
        parsed = json.loads(schema)
    except (TypeError, ValueError) as e:
        raise InvalidJsonSchema(f"not JSON: {e}") from e
    if not isinstance(parsed, dict):
        raise InvalidJsonSchema("a schema is a JSON object")
    return parsed


def _resolved(node, root: dict, seen: tuple[str, ...] = ()) -> dict:
    """A node with its local references followed and ``anyOf``/``oneOf`` with null reduced to the other branch."""
    if not isinstance(node, dict):
        raise InvalidJsonSchema("a schema node is a JSON object")
    if "$ref" in node:
        ref = node["$ref"]
        if ref in seen:
            raise InvalidJsonSchema(f"the reference {ref!r} leads to itself")
        target = root
        if not isinstance(ref, str) or not ref.startswith("#/"):
            raise InvalidJsonSchema(f"unsupported reference {ref!r}")
        for step in ref[2:].split("/"):
            target = target.get(step.replace("~1", "/").replace("~0", "~")) if isinstance(target, dict) else None
        if target is None:
            raise InvalidJsonSchema(f"the reference {ref!r} leads nowhere")
        return _resolved(target, root, (*seen, ref))
    for union in ("anyOf", "oneOf"):
        if union in node and "type" not in node:
            others = [b for b in node[union] if not (isinstance(b, dict) and b.get("type") == "null")]
            if len(others) != 1:
                raise InvalidJsonSchema(f"{union} may join one type with null")
            return _resolved(others[0], root, seen)
    return node


def _enum_type(values: list) -> str:
    kinds = {type(v) for v in values if v is not None}
    for kind, name in ((str, "string"), (bool, "boolean"), (int, "integer"), (float, "number")):
        if kinds == {kind}:
            return name
    if kinds == {int, float}:
        return "number"
    raise InvalidJsonSchema("the values of an enum are of one scalar type")


def spark_type(node: dict, root: dict | None = None, depth: int = 0) -> T.DataType:
    """Spark type of one schema node; an open object becomes a variant."""
    root = node if root is None else root
    if depth > MAX_DEPTH:
        raise InvalidJsonSchema("the schema is nested too deeply or refers to itself")
    node = _resolved(node, root)
    kind = node.get("type")
    if isinstance(kind, list):
        kind = next((k for k in kind if k != "null"), None)
    if kind is None and node.get("enum"):
        kind = _enum_type(node["enum"])
    if kind == "object" or (kind is None and "properties" in node):
        if not node.get("properties"):
            return T.VariantType()
        return T.StructType([T.StructField(n, spark_type(p, root, depth + 1)) for n, p in node["properties"].items()])
    if kind == "array":
        return T.ArrayType(spark_type(node.get("items") or {"type": "string"}, root, depth + 1))
    if kind in SCALARS:
        return SCALARS[kind]
    raise InvalidJsonSchema(f"unsupported type {kind!r}")


def json_schema_to_struct(schema: str | dict) -> T.StructType:
    """Top level must be an object with properties; what it requires must be among them."""
    loaded = load(schema)
    out = spark_type(loaded)
    if not isinstance(out, T.StructType):
        raise InvalidJsonSchema("the top level must be an object with properties")
    required(loaded)
    return out


def required(schema: str | dict) -> list[tuple[str, ...]]:
    """Paths of the required fields, nested ones too; a name that is no property is an invalid schema."""
    root = load(schema)

    def of(node: dict, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        node = _resolved(node, root)
        properties = node.get("properties") or {}
        names = list(node.get("required") or [])
        unknown = [n for n in names if n not in properties]
        if unknown and (properties or not path):
            raise InvalidJsonSchema(f"required but no property: {', '.join(map(str, unknown))}")
        out = [(*path, n) for n in names if n in properties]
        for n, child in properties.items():
            child = _resolved(child, root)
            if child.get("properties"):
                out += of(child, (*path, n))
        return out

    return of(root, ())
