"""Dead-letter queue: validate, route, recover, poison (DLQ1-DLQ4, ST2, AG6).

Validation of raw message bytes, in order: not UTF-8 / not exactly one JSON
document / NULL -> ``invalid_json``; not an object -> ``not_an_object``;
required keys missing -> ``missing_fields: ['a', 'b']`` (in required order; a
key with a null value is present).  Everything is one projection, so a
validated batch can be split into good and dead rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.materialize import computed
from logweave.functions.serde import has_field, header_value, map_to_headers, parse_json

# Required fields and recovery defaults of the reference.
REQUIRED_FIELDS = ("order_id", "customer", "amount")
RECOVERY_DEFAULTS = (("customer", '"unknown"', "unknown"),
                     ("amount", "0.0", 0.0),
                     ("order_id", '"recovered"', "recovered"))
ERR_INVALID_JSON = "invalid_json"
ERR_NOT_OBJECT = "not_an_object"
ERR_MISSING = "missing_fields"


def _text(value: Column) -> Column:
    return F.when(F.is_valid_utf8(value), value.cast("string"))


def _missing_list(v: Column, required: Sequence[str]) -> Column:
    """``'a', 'b'`` for the required keys absent from object ``v`` (required
    order); plain conditionals, so the projection stays in whole-stage codegen."""
    return F.concat_ws(", ", *[F.when(~has_field(v, f), F.lit(f"'{f}'")) for f in required])


def _any_missing(v: Column, required: Sequence[str]) -> Column:
    out = None
    for f in required:
        m = ~has_field(v, f)
        out = m if out is None else (out | m)
    return out


def classify(df: DataFrame, value_col: str = "value",
             required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Add ``error`` (NULL for valid rows) (DLQ1)."""
    return _classified(df, value_col, required).drop("_v")


def _classified(df: DataFrame, value_col: str, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """``error`` and ``_v``, the parsed value.

    The text is decoded, parsed and its keys extracted once per row in
    separate projections (Catalyst keeps expensive expressions from being
    duplicated when it merges them)."""
    b = F.col(value_col)
    staged = (df.withColumn("_t", _text(b))
              .withColumns({"_w1": F.try_parse_json(F.concat(F.lit("["), F.col("_t"), F.lit("]"))),
                            "_w2": F.try_parse_json(F.concat(F.lit('{"w":'), F.col("_t"),
                                                             F.lit("}")))}))
    staged = staged.withColumn("_v", F.when(F.col("_w1").isNotNull() & F.col("_w2").isNotNull(),
                                            F.try_variant_get("_w1", "$[0]", "variant")))
    staged = staged.withColumn("_obj", F.coalesce(
        F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
    v = F.col("_v")
    err = (F.when(v.isNull(), ERR_INVALID_JSON)
           .when(~F.col("_obj"), ERR_NOT_OBJECT)
           .when(_any_missing(v, required),
                 F.concat(F.lit(f"{ERR_MISSING}: ["), _missing_list(v, required), F.lit("]"))))
    return computed(staged, {"error": err}).drop("_t", "_w1", "_w2", "_obj")


def validation_error(value: Column | str, required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Error string of a raw message as a single expression (for ad-hoc use;
    :func:`classify` is the staged, faster form)."""
    b = F.col(value) if isinstance(value, str) else value
    text = _text(b)
    v = parse_json(text)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return (F.when(v.isNull(), ERR_INVALID_JSON)
            .when(~is_obj, ERR_NOT_OBJECT)
            .when(_any_missing(v, required),
                  F.concat(F.lit(f"{ERR_MISSING}: ["), _missing_list(v, required), F.lit("]"))))


def valid_rows(classified: DataFrame) -> DataFrame:
    """Rows that passed validation (the main flow)."""
    return classified.filter(F.col("error").isNull())


def dead_letters(classified: DataFrame, source_topic: str, value_col: str = "value",
                 key_col: str = "key", offset_col: str = "off",
                 partition_col: str | None = "partition") -> DataFrame:
    """Rows for the DLQ topic (DLQ2): original bytes, key and headers
    ``error``, ``source_topic``, ``source_offset`` (+ ``source_partition``)."""
    hdr = {"error": F.col("error"), "source_topic": source_topic,
           "source_offset": F.col(offset_col).cast("string")}
    if partition_col:
        hdr["source_partition"] = F.col(partition_col).cast("string")
    return (classified.filter(F.col("error").isNotNull())
            .select(F.col(key_col).alias("key"), F.col(value_col).alias("value"),
                    map_to_headers(hdr).alias("headers")))


def recover(dlq: DataFrame, value_col: str = "value") -> DataFrame:
    """Repair dead letters whose error is ``missing_fields*`` (DLQ3).

    Missing keys get defaults (customer 'unknown', amount 0.0, order_id
    'recovered'), appended after the original members; extra fields are kept.
    A missing ``error`` header reads as 'unknown' and is not recoverable.
    Output: key, value (fixed JSON bytes), order_id, customer, amount, error.
    """
    staged = (dlq.withColumn("error", F.coalesce(header_value("headers", "error"),
                                                 F.lit("unknown")))
              .withColumn("_t", _text(F.col(value_col))))
    staged = staged.withColumn("_v", parse_json("_t"))
    staged = staged.withColumn("_keys", F.json_object_keys("_t"))
    text, v, keys = F.col("_t"), F.col("_v"), F.col("_keys")
    staged = computed(staged, {"_ok": F.col("error").startswith(ERR_MISSING) & F.coalesce(
        F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))})
    ok = F.col("_ok")
    add = [F.when(~F.array_contains(keys, f), F.lit(f'"{f}":{js}')) for f, js, _ in
           RECOVERY_DEFAULTS]
    members = F.concat_ws(",", *add)
    body = F.regexp_replace(text, r"\}\s*$", "")
    sep = F.when((F.size(keys) > 0) & (F.length(members) > 0), ",").otherwise("")
    fixed = F.concat(body, sep, members, F.lit("}"))

    def field(name: str, type_name: str, default) -> Column:
        return F.when(F.array_contains(keys, name),
                      F.try_variant_get(v, f"$.{name}", type_name)).otherwise(
            F.lit(default).cast(type_name))

    return (staged.filter(ok)
            .select("key", F.encode(fixed, "UTF-8").alias("value"),
                    field("order_id", "string", "recovered").alias("order_id"),
                    field("customer", "string", "unknown").alias("customer"),
                    field("amount", "double", 0.0).alias("amount"), "error"))


def poison(dlq: DataFrame, value_col: str = "value") -> DataFrame:
    """Unrecoverable dead letters (DLQ4): key, value, error."""
    staged = dlq.withColumn("error", F.coalesce(header_value("headers", "error"),
                                                F.lit("unknown")))
    is_obj = F.coalesce(F.schema_of_variant(parse_json(_text(F.col(value_col))))
                        .startswith("OBJECT"), F.lit(False))
    staged = computed(staged, {"_poison": ~(F.col("error").startswith(ERR_MISSING) & is_obj)})
    return staged.filter("_poison").select("key", value_col, "error")


def typed_orders(valid: DataFrame, value_col: str = "value") -> DataFrame:
    """Valid order messages as typed columns: key, order_id, customer, amount."""
    v = parse_json(_text(F.col(value_col)))
    return valid.select("key",
                        F.try_variant_get(v, "$.order_id", "string").alias("order_id"),
                        F.try_variant_get(v, "$.customer", "string").alias("customer"),
                        F.try_variant_get(v, "$.amount", "double").alias("amount"))


def reprocess(main: DataFrame, recovered: DataFrame, value_col: str = "value") -> DataFrame:
    """Recovered rows re-enter the main flow and are validated again (ST2).
    Output: key, order_id, customer, amount, origin."""
    m = typed_orders(valid_rows(classify(main, value_col)), value_col) \
        .withColumn("origin", F.lit("main"))
    r = typed_orders(valid_rows(classify(recovered.select("key", value_col), value_col)),
                     value_col).withColumn("origin", F.lit("recovered"))
    return m.unionByName(r)


def reprocess_log(main: DataFrame, value_col: str = "value") -> DataFrame:
    """:func:`reprocess` of a log together with its own recovered dead letters, each message
    parsed once: a message that only lacks fields comes back with their defaults, which is
    what recovery and a second validation give.  Output: key, order_id, customer, amount,
    origin."""
    v = F.col("_v")
    kinds = {"order_id": "string", "customer": "string", "amount": "double"}
    fields = [F.when(has_field(v, f), F.try_variant_get(v, f"$.{f}", kinds[f]))
              .otherwise(F.lit(default).cast(kinds[f])).alias(f) for f, _, default in RECOVERY_DEFAULTS]
    kept = _classified(main, value_col).filter(
        F.col("error").isNull() | F.col("error").startswith(ERR_MISSING))
    return kept.select("key", *fields, F.when(F.col("error").isNull(), "main").otherwise("recovered")
                       .alias("origin")).select("key", "order_id", "customer", "amount", "origin")


def outcome_counts(main: DataFrame, value_col: str = "value") -> DataFrame:
    """Counters of one pass (AG6): ok, routed, recovered, poison."""
    c = classify(main, value_col)
    err = F.col("error")
    recoverable = err.startswith(ERR_MISSING)
    return c.agg(F.count_if(err.isNull()).alias("ok"),
                 F.count_if(err.isNotNull()).alias("routed"),
                 F.count_if(F.coalesce(recoverable, F.lit(False))).alias("recovered"),
                 F.count_if(err.isNotNull() & ~F.coalesce(recoverable, F.lit(False)))
                 .alias("poison"))
