"""JSON-Schema subset validation compiled to Spark expressions (FN16).

Supported keywords: ``type``, ``required``, ``properties`` (nested) and array
``items``.  ``compile_errors(value, schema)`` turns the (small, static)
schema dict into one Column of ``array<string>`` error messages with JSON
paths; an empty array means valid.  Booleans are never integers or numbers.
The schema is walked once on the driver; the data never leaves Spark.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.serde import member_path, python_type

# JSON-Schema type -> accepted Python type names.
TYPE_NAMES = {
    "string": ("str",),
    "integer": ("int",),
    "number": ("int", "float"),
    "boolean": ("bool",),
    "object": ("dict",),
    "array": ("list",),
    "null": ("NoneType",),
}



def _empty() -> Column:
    return F.array().cast("array<string>")


def _member(v: Column, key: str) -> Column:
    return F.try_variant_get(v, member_path(key), "variant")


def _has(v: Column, key: str) -> Column:
    return _member(v, key).isNotNull()


def compile_errors(v: Column, schema: dict[str, Any], path: Column | None = None) -> Column:
    """``array<string>`` of validation errors of VARIANT ``v``."""
    path = path if path is not None else F.lit("$")
    expected = schema.get("type")
    pyt = python_type(v)
    checks: list[Column] = []
    type_err = None
    if expected:
        accepted = TYPE_NAMES.get(expected, ())
        if expected in ("integer", "number"):
            type_err = F.when(pyt == "bool", F.array(F.concat(
                path, F.lit(f": expected {expected}, got boolean"))))
        if accepted:
            e2 = F.when(~pyt.isin(*accepted), F.array(F.concat(
                path, F.lit(f": expected {expected}, got "), pyt)))
            type_err = e2 if type_err is None else F.coalesce(type_err, e2)
    if expected == "object":
        for key in schema.get("required", []):
            checks.append(F.when(~_has(v, key), F.array(F.concat(
                path, F.lit(f": missing required property '{key}'")))).otherwise(_empty()))
        for key, sub in schema.get("properties", {}).items():
            checks.append(F.when(_has(v, key), compile_errors(
                _member(v, key), sub, F.concat(path, F.lit(f".{key}")))).otherwise(_empty()))
    if expected == "array" and isinstance(schema.get("items"), dict):
        items = F.try_variant_get(v, "$", "array<variant>")
        nested = F.transform(items, lambda x, i: compile_errors(
            x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        checks.append(F.coalesce(F.flatten(nested), _empty()))
    body = F.concat(*checks) if checks else _empty()
    if type_err is not None:
        return F.coalesce(type_err, body)
    return body


def validate(v: Column, schema: dict[str, Any]) -> Column:
    """Alias of :func:`compile_errors` for a top-level value."""
    return compile_errors(v, schema)
