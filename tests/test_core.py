"""Unit cases kept from the reference's tests, as DataFrame operations."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logweave.functions import serde
from logweave.functions.jsonschema import compile_errors
from logweave.operators import cdc, dlq, metrics
from logweave.operators import eventsourcing as es
from logweave.sources import kafka


def _bytes_df(spark, values):
    return spark.createDataFrame([(i, None if v is None else bytearray(v))
                                  for i, v in enumerate(values)], "off long, value binary")


def test_decode_json_text_null(spark):
    df = _bytes_df(spark, [b'{"x": 1}', b"not json", None, b"\xff\xfe"])
    rows = df.select(serde.decode_value("value").alias("d")).select(
        "d.kind", "d.text", F.try_variant_get("d.json", "$.x", "int").alias("x")).collect()
    assert [r.kind for r in rows] == ["json", "text", "null", "bytes"]
    assert rows[0].x == 1 and rows[1].text == "not json" and rows[2].text is None


def test_encode_variants(spark):
    df = spark.createDataFrame([(1, "hello", bytearray(b"raw"), "安藤")],
                               "a int, s string, b binary, name string")
    r = df.select(serde.encode_value(F.struct("a")).alias("j"),
                  serde.encode_value("s", "string").alias("s"),
                  serde.encode_value("b", "binary").alias("b"),
                  serde.encode_value(F.lit(None).cast("string"), "string").alias("n"),
                  serde.encode_value(F.struct("name")).alias("u")).first()
    assert bytes(r.j) == b'{"a":1}'
    assert bytes(r.s) == b"hello" and bytes(r.b) == b"raw" and bytes(r.n) == b""
    assert bytes(r.u).decode("utf-8") == '{"name":"安藤"}'


def test_delivery_metrics_error_rate(spark):
    rows = [("x", True, 10, i) for i in range(8)] + [("x", False, 10, 9), ("x", False, 10, 10)]
    df = spark.createDataFrame(rows, "config string, ok boolean, n_bytes long, sent_epoch long")
    r = metrics.delivery_metrics(df).first()
    assert r.delivered == 8 and r.failed == 2 and r.error_rate == pytest.approx(0.2)
    assert r.throughput_msg_s > 0 and r.bytes_sent == 80


def test_event_round_trip(spark):
    df = spark.createDataFrame([("o1", "OrderCreated", "alice", 100.0)],
                               "aggregate_id string, event_type string, customer string, "
                               "amount double")
    back = es.events_from_json(es.events_to_json(df).select("value")).first()
    assert back.event_type == "OrderCreated" and back.customer == "alice"
    assert back.amount == 100.0 and back.method is None


def test_unknown_event_type_keeps_base_fields(spark):
    df = spark.createDataFrame([('{"aggregate_id":"a","event_type":"Refund","amount":5}',)],
                               "value string")
    r = es.events_from_json(df).first()
    assert r.event_type == "Refund" and r.aggregate_id == "a" and r.amount is None


def test_cdc_envelope_shape(spark):
    e = spark.range(1).select(cdc.envelope(
        "c", F.lit(None).cast("struct<id:long>"),
        F.struct(F.lit(1).alias("id"), F.lit("x").alias("customer"),
                 F.lit("NEW").alias("status"), F.lit(1.0).alias("amount")),
        ts_ms=F.lit(0).cast("long")).alias("e")).first().e
    assert e.op == "c" and e.before is None and e.after.id == 1
    assert e.source.table == "orders"


def test_dlq_validation(spark):
    df = _bytes_df(spark, [b'{"order_id":"1","customer":"a","amount":10}', b"not-json{",
                           b'{"order_id":"1"}', b"[1]", None, b'{"a":1} x',
                           b'{"order_id":"1","customer":null,"amount":1}'])
    errs = [r.error for r in dlq.classify(df).orderBy("off").collect()]
    assert errs[0] is None
    assert errs[1] == "invalid_json"
    assert errs[2] == "missing_fields: ['customer', 'amount']"
    assert errs[3] == "not_an_object"
    assert errs[4] == "invalid_json"
    assert errs[5] == "invalid_json"          # trailing garbage is not JSON
    assert errs[6] is None                     # a null value counts as present


def test_dlq_recovery(spark):
    raw = spark.createDataFrame(
        [("k1", bytearray(b'{"order_id":"1"}')), ("k2", bytearray(b"not-json")),
         ("k3", bytearray(b'{"order_id":"2","note":"x"}'))],
        "key string, value binary").withColumn("off", F.lit(0).cast("long")) \
        .withColumn("partition", F.lit(0))
    dead = dlq.dead_letters(dlq.classify(raw), "t")
    rec = {r.key: r for r in dlq.recover(dead).collect()}
    assert rec["k1"].amount == 0.0 and rec["k1"].customer == "unknown"
    assert json.loads(bytes(rec["k3"].value)) == {"order_id": "2", "note": "x",
                                                  "customer": "unknown", "amount": 0.0}
    assert [r.key for r in dlq.poison(dead).collect()] == ["k2"]
    # Recovered rows validate on the second pass.
    again = dlq.classify(dlq.recover(dead).select("key", "value"))
    assert again.filter(F.col("error").isNotNull()).count() == 0


def _schema_errors(spark, doc, schema):
    df = spark.createDataFrame([(json.dumps(doc),)], "t string")
    return df.select(compile_errors(serde.parse_json("t"), schema).alias("e")).first().e


def test_schema_validation(spark):
    schema = {"type": "object", "required": ["id", "amount"],
              "properties": {"id": {"type": "integer"}, "amount": {"type": "number"}}}
    assert _schema_errors(spark, {"id": 1, "amount": 9.5}, schema) == []
    errs = _schema_errors(spark, {"id": "x"}, schema)
    assert any("id" in e for e in errs) and any("amount" in e for e in errs)
    assert len(_schema_errors(spark, {"n": True},
                              {"type": "object", "properties": {"n": {"type": "integer"}}})) == 1


def test_schema_validation_nested_items(spark):
    schema = {"type": "object", "properties": {"xs": {"type": "array",
                                                      "items": {"type": "integer"}}}}
    errs = _schema_errors(spark, {"xs": [1, "a", 2.5]}, schema)
    assert errs == ["$.xs[1]: expected integer, got str", "$.xs[2]: expected integer, got float"]


def test_header_lookup_last_wins(spark):
    df = spark.createDataFrame([([("a", bytearray(b"1")), ("a", bytearray(b"2"))],)],
                               "headers array<struct<key:string,value:binary>>")
    r = df.select(serde.header_value("headers", "a").alias("a"),
                  serde.header_value("headers", "b").alias("b"),
                  serde.headers_to_map("headers").alias("m")).first()
    assert r.a == "2" and r.b is None and r.m == {"a": "2"}


def test_kafka_options():
    sink = kafka.connector_options("b:1", sink=True)
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"
    assert kafka.connector_options("b:1", {"acks": 1}, sink=True)["kafka.acks"] == "1"
    src = kafka.connector_options("b:1", {"group.id": "g", "kafka.auto.offset.reset": "latest",
                                          "check.crcs": True})
    assert src == {"kafka.bootstrap.servers": "b:1", "kafka.check.crcs": "true"}
    assert kafka.source_options(["a", "b"], read_committed=True)["subscribe"] == "a,b"


def test_whatif_unknown_scenario(spark):
    with pytest.raises(ValueError):
        es.whatif(spark.range(1), "drop-everything")


def test_kafka_security_and_topic_guard(spark):
    opts = kafka.connector_options("b:1", login=("u", 'p"w'))
    assert opts["kafka.security.protocol"] == "SASL_SSL"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u" password="p\\"w";' in opts["kafka.sasl.jaas.config"]
    with pytest.raises(ValueError):
        kafka.write_kafka(spark.range(1).selectExpr("CAST(id AS STRING) AS value"), "b:1")


def test_snapshot_diff_envelope(spark):
    old = spark.createDataFrame([(1, "a")], "id long, status string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "id long, status string")
    rows = cdc.snapshot_diff(old, new, ts_ms=F.lit(123).cast("long")).orderBy("op").collect()
    assert [r.op for r in rows] == ["c", "u"]
    assert rows[0].source.table == "orders" and rows[0].ts_ms == 123
    assert rows[1].before.status == "a" and rows[1].after.status == "b"
