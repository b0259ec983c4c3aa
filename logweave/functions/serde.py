"""Message (de)serialisation and JSON field access (FN1-FN7).

All functions are Column expressions over Spark's JSON and VARIANT
functions; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------- strict JSON
def strict_json(text: Column | str) -> Column:
    """True when ``text`` is exactly one JSON document.

    ``try_parse_json`` alone accepts trailing garbage; a document wrapped as
    an array element *and* as an object member parses only if it is complete.
    """
    t = _c(text)
    return (F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull()
            & F.try_parse_json(F.concat(F.lit('{"w":'), t, F.lit("}"))).isNotNull())


def parse_json(text: Column | str) -> Column:
    """VARIANT of a strictly valid JSON text, else NULL (the document is
    taken from the array wrap, so the text is parsed twice, not three times)."""
    t = _c(text)
    w1 = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    w2 = F.try_parse_json(F.concat(F.lit('{"w":'), t, F.lit("}")))
    return F.when(w1.isNotNull() & w2.isNotNull(), F.try_variant_get(w1, "$[0]", "variant"))


def json_kind(v: Column) -> Column:
    """JSON-level kind of a VARIANT: object, array, string, number, boolean, null."""
    s = F.schema_of_variant(v)
    return (F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array")
            .when(s == "STRING", "string").when(s == "BOOLEAN", "boolean")
            .when(s == "VOID", "null").when(s.isNotNull(), "number"))


def python_type(v: Column) -> Column:
    """Python type name the reference's ``json.loads`` would produce.

    Spark keeps ``1`` as BIGINT and ``1.0`` as DECIMAL(p,0); integers too
    large for BIGINT arrive as DECIMAL(p>=19,0) and are still ``int``.
    """
    s = F.schema_of_variant(v)
    big_int = s.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$")
    return (F.when(s.startswith("OBJECT"), "dict").when(s.startswith("ARRAY"), "list")
            .when(s == "STRING", "str").when(s == "BOOLEAN", "bool")
            .when(s == "VOID", "NoneType").when(s == "BIGINT", "int")
            .when(big_int, "int").when(s.isNotNull(), "float"))


def is_object(v: Column) -> Column:
    """FN4: the decoded value is a JSON object."""
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


# ----------------------------------------------------------- decode (FN1)
def decode_value(value: Column | str) -> Column:
    """Best-effort decode of message bytes (FN1): JSON if possible, else UTF-8
    text, else raw bytes; NULL stays NULL.

    Returns struct<kind, text, json VARIANT, raw BINARY>.
    """
    b = _c(value)
    utf8 = F.is_valid_utf8(b)
    text = F.when(utf8, b.cast("string"))
    js = parse_json(text)
    kind = (F.when(b.isNull(), "null").when(~utf8, "bytes")
            .when(js.isNotNull(), "json").otherwise("text"))
    return F.struct(kind.alias("kind"), text.alias("text"), js.alias("json"),
                    F.when(b.isNotNull() & ~utf8, b).alias("raw"))


def decode_key(key: Column | str) -> Column:
    """FN3: UTF-8 key, NULL when absent or empty."""
    k = _c(key)
    return F.when(k.isNotNull() & (F.length(k) > 0), k.cast("string"))


def headers_to_map(headers: Column | str) -> Column:
    """FN3: header list ``array<struct<key, value BINARY>>`` -> map<string, string>
    (last value wins on repeated keys, as in a dict)."""
    h = _c(headers)
    entries = F.transform(h, lambda x: F.struct(x["key"].alias("key"),
                                                 x["value"].cast("string").alias("value")))
    return F.when(h.isNull() | (F.size(h) == 0), F.create_map().cast("map<string,string>")) \
        .otherwise(F.map_from_entries(
            F.filter(entries, lambda e, i: ~F.exists(
                F.slice(entries, i + 2, F.size(entries)), lambda f: f["key"] == e["key"]))))


def header_value(headers: Column | str, key: str) -> Column:
    """FN3: value of header ``key`` as text (last occurrence wins, as in a
    dict), NULL when absent.  Built-in array functions only, so it compiles
    into whole-stage code."""
    h = _c(headers)
    idx = F.array_position(F.reverse(h.getField("key")), F.lit(key)).cast("int")
    return F.when(idx > 0, F.element_at(F.reverse(h.getField("value")), idx).cast("string"))


def map_to_headers(m: dict[str, Column | str]) -> Column:
    """Header list from literal keys and string columns."""
    return F.array(*[F.struct(F.lit(k).alias("key"),
                              F.encode(_c(v).cast("string") if not isinstance(v, str)
                                       else F.lit(v), "UTF-8").alias("value"))
                     for k, v in m.items()])


# ----------------------------------------------------------- encode (FN2)
def encode_value(value: Column | str, data_type: str | None = None) -> Column:
    """FN2: NULL -> empty bytes, BINARY as-is, STRING as UTF-8, anything else
    as compact JSON (non-ASCII characters and null members kept)."""
    v = _c(value)
    if data_type == "binary":
        out = v
    elif data_type == "string":
        out = F.encode(v, "UTF-8")
    else:
        out = F.encode(F.to_json(v, {"ignoreNullFields": "false"}), "UTF-8")
    return F.coalesce(out, F.lit(b"").cast("binary"))


# --------------------------------------------------- field access (FN5-FN7)
def member_path(field: str) -> str:
    """VARIANT path of an object member.  Path texts have no escapes, so the form is
    chosen by the characters of the key; a key that fits none raises."""
    for bad, form in (("'?", "$['{}']"), ('"?', '$["{}"]'), (".[", "$.{}")):
        if field and not set(bad) & set(field):
            return form.format(field)
    raise ValueError(f"no path for member {field!r}")


def has_field(v: Column, field: str) -> Column:
    """Key present in the object (an explicit null counts as present: a JSON
    null member is a VARIANT null, not SQL NULL)."""
    return F.try_variant_get(v, member_path(field), "variant").isNotNull()


def get_or_default(v: Column, field: str, type_name: str, default) -> Column:
    """FN5: ``value.get(field, default)``: the default applies only when the
    key is missing; an explicit JSON null stays NULL."""
    return F.when(has_field(v, field), F.try_variant_get(v, member_path(field), type_name)) \
        .otherwise(F.lit(default).cast(type_name))


def to_number(v: Column, field: str) -> Column:
    """FN6: numeric coercion; numeric strings parse, anything else -> NULL
    (callers route NULLs to an error output instead of reading them as 0)."""
    return F.try_variant_get(v, member_path(field), "double")


def nested(v: Column, path: str, type_name: str = "variant") -> Column:
    """FN7: nested access, e.g. ``nested(v, "payload.amount", "double")``; dots
    separate members."""
    return F.try_variant_get(v, "$" + "".join(member_path(p)[1:] for p in path.split(".")),
                             type_name)
