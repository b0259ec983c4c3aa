"""Hand-worked histories: fold, joins, CDC, percentiles, filters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logweave.functions import transforms
from logweave.operators import cdc, joins, metrics
from logweave.operators import eventsourcing as es

LOG = ("aggregate_id string, seq long, event_type string, amount double, customer string, "
       "method string, carrier string, tracking string, reason string")


def _log(spark, rows):
    full = [(a, s, t, amt, None, None, None, None, None) for a, s, t, amt in rows]
    return spark.createDataFrame(full, LOG)


def _fold(spark, rows):
    return {r.order_id: (r.status, r.paid) for r in es.fold_states(_log(spark, rows)).collect()}


def test_fold_histories(spark):
    rows = [("a", 1, "OrderCreated", 100.0), ("a", 2, "PaymentReceived", 60.0),
            ("a", 3, "PaymentReceived", 40.0), ("a", 4, "OrderShipped", None),
            ("b", 1, "PaymentReceived", 5.0),
            ("c", 1, "PaymentReceived", 5.0), ("c", 2, "OrderCreated", 4.0),
            ("d", 1, "OrderCreated", 10.0), ("d", 2, "OrderCancelled", None),
            ("d", 3, "PaymentReceived", 3.0),
            ("e", 1, "OrderCreated", 10.0), ("e", 2, "OrderShipped", None),
            ("e", 3, "PaymentReceived", 10.0),
            ("f", 1, "Refund", 1.0),
            # negative payment: exact window path
            ("g", 1, "OrderCreated", 10.0), ("g", 2, "PaymentReceived", 15.0),
            ("g", 3, "PaymentReceived", -10.0), ("g", 4, "OrderShipped", None),
            ("g", 5, "PaymentReceived", -1.0)]
    got = _fold(spark, rows)
    assert got == {"a": ("SHIPPED", 100.0), "b": ("PAID", 5.0), "c": ("CREATED", 5.0),
                   "d": ("CANCELLED", 3.0), "e": ("PAID", 10.0), "f": ("UNKNOWN", 0.0),
                   "g": ("SHIPPED", 4.0)}


def test_rebuild_state_one_and_missing(spark):
    log = _log(spark, [("a", 1, "OrderCreated", 100.0), ("a", 2, "PaymentReceived", 100.0)])
    r = es.rebuild_state(log, "a").first()
    assert (r.status, r.paid, r.amount) == ("PAID", 100.0, 100.0)
    none = es.rebuild_state(log, "zzz").collect()
    assert len(none) == 1 and none[0].status == "UNKNOWN" and none[0].paid == 0.0


def test_event_history_running_state(spark):
    log = _log(spark, [("a", 1, "OrderCreated", 10.0), ("a", 2, "PaymentReceived", 4.0),
                       ("a", 3, "PaymentReceived", 6.0), ("a", 4, "OrderShipped", None)])
    h = es.event_history(log, "a").collect()
    assert [r.status for r in h] == ["CREATED", "CREATED", "PAID", "SHIPPED"]
    assert [r.paid for r in h] == [0.0, 4.0, 10.0, 10.0]


def _sides(spark, orders, payments):
    o = spark.createDataFrame(orders, "order_id string, amount double, order_epoch double")
    p = spark.createDataFrame(payments, "order_id string, amount double, method string, "
                                        "payment_epoch double")
    return o, p


def test_interval_join_bounds(spark):
    o, p = _sides(spark, [("a", 1.0, 1000.0), ("b", 1.0, 1000.0), ("c", 1.0, 1000.0),
                          ("d", 1.0, 1000.0)],
                  [("a", 1.0, "card", 1000.0), ("b", 1.0, "card", 1300.0),
                   ("c", 1.0, "card", 1300.001)])
    got = {r["order_id"] for r in joins.interval_join(o, p, "order_id", "order_epoch",
                                                      "payment_epoch").select("_l.order_id")
           .collect()}
    assert got == {"a", "b"}
    un = {r.order_id for r in joins.unmatched(o, p, "order_id", "order_epoch",
                                              "payment_epoch").collect()}
    assert un == {"c", "d"}


def test_consume_on_match(spark):
    o, p = _sides(spark,
                  [("x", 1.0, 0.0), ("y", 1.0, 0.0), ("y", 2.0, 20.0), ("z", 1.0, 0.0),
                   ("z", 2.0, 1.0)],
                  [("x", 1.0, "card", 5.0), ("x", 2.0, "card", 6.0),
                   ("y", 1.0, "card", 10.0), ("y", 2.0, "card", 30.0),
                   ("z", 9.0, "card", 2.0)])
    out = joins.consume_on_match(o, p, "order_id", "order_epoch", "payment_epoch", 300)
    m = out.filter("matched").collect()
    per_key = {}
    for r in m:
        per_key.setdefault(r.key, []).append((r.l_amount, r.r_amount))
    assert per_key["x"] == [(1.0, 1.0)]                  # O, P, P -> one row
    assert sorted(per_key["y"]) == [(1.0, 1.0), (2.0, 2.0)]   # O, P, O, P -> two rows
    assert per_key["z"] == [(2.0, 9.0)]                  # O1, O2, P -> joins O2
    unmatched = {(r.key, r.l_amount) for r in out.filter(~F.col("matched")).collect()}
    assert unmatched == {("z", 1.0)}


def test_cdc_apply_histories(spark):
    row = "struct<id:long,customer:string,status:string,amount:double>"
    data = [
        (1, "c", None, (1, "a", "NEW", 1.0)), (2, "u", (1, "a", "NEW", 1.0), (1, "a", "PAID", 1.0)),
        (3, "u", (1, "a", "PAID", 1.0), (1, "a", "SHIPPED", 1.0)),
        (4, "c", None, (2, "b", "NEW", 2.0)), (5, "d", (2, "b", "NEW", 2.0), None),
        (6, "d", (3, "c", "NEW", 3.0), None), (7, "c", None, (3, "c", "NEW", 3.0)),
        (8, "c", None, None), (9, "x", None, (4, "d", "NEW", 4.0)),
    ]
    df = spark.createDataFrame(data, f"off long, op string, before {row}, after {row}")
    got = {r.id: r.status for r in cdc.apply_changes(df).collect()}
    assert got == {1: "SHIPPED", 3: "NEW"}
    # Applying in two batches gives the same replica.
    first = cdc.apply_changes(df.filter("off <= 4"))
    inc = cdc.apply_incremental(first, df.filter("off > 4"))
    assert {r.id: r.status for r in inc.collect()} == got


def test_snapshot_diff_ops(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, status string")
    new = spark.createDataFrame([(2, "b"), (3, "x"), (4, "d")], "id long, status string")
    d = {(r.op, (r.before or r.after).id) for r in cdc.snapshot_diff(old, new).collect()}
    assert d == {("d", 1), ("u", 3), ("c", 4)}
    with pytest.raises(ValueError, match="note"):
        cdc.snapshot_diff(old, new.withColumn("note", new.status))


def test_percentile_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (4, 1, 3, 2)]
                               + [("b", 1.0), ("b", 2.0)], "g string, v double")
    r = {x.g: x for x in metrics.nearest_rank_percentiles(df, ["g"], "v", (50,)).collect()}
    assert r["a"].p50 == 3.0 and r["b"].p50 == 1.0 and r["a"].measured == 4


def test_tiers_and_threshold(spark):
    df = spark.createDataFrame([(x,) for x in (10000.0, 10000.01, 50000.0, 50000.01,
                                               100000.0, 100000.01)], "amount double")
    got = [(r.amount, r.tier) for r in transforms.high_value(df, stamp_col="filtered_at")
           .orderBy("amount").collect()]
    assert got == [(10000.01, "silver"), (50000.0, "silver"), (50000.01, "gold"),
                   (100000.0, "gold"), (100000.01, "platinum")]
