"""Event-log views derived from the driver's test tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame that plays the
role of one of the reference's topics.  The same views exist as DuckDB SQL in
:mod:`logweave.plans.oracle`; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.functions.timecols import epoch_micros, epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of one test table (the file source needs a directory,
    so the table file is selected with a glob filter)."""
    schema = table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _money_text(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _epoch_s(c: str) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ column."""
    return F.floor(epoch_micros(c) / F.lit(1_000_000)).cast("bigint")


# --------------------------------------------------------------- F1 analytics
def analytics_events(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """``analytics.events.v1``: event_id, type, user_id, product, event_epoch, amount.
    ``ev`` may be a streaming read of the events table."""
    ev = ev if ev is not None else table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        "event_id",
        F.when(et == "view", "page_view").when(et == "click", "add_to_cart")
        .otherwise(et).alias("type"),
        F.concat(F.lit("user-"), _s("user_id")).alias("user_id"),
        F.concat(F.lit("SKU-"), F.lpad(_s(F.col("event_id") % 20), 3, "0")).alias("product"),
        epoch_seconds("ts").alias("event_epoch"),
        F.when(et == "purchase", F.col("value")).alias("amount"),
    )


def arriving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 events as they arrive: event_id, event_epoch, arrival (0 to 3).  An event arrives in
    the quarter of the log's time span that it belongs to, every 20th one quarter later;
    every 50th or so has no time."""
    ev = analytics_events(spark, sf_dir)
    lo, hi = (ev.select(f("event_epoch")).scalar() for f in (F.min, F.max))
    quarter = F.floor(4 * (F.col("event_epoch") - lo) / (hi - lo + 1))
    late = F.when(F.col("event_id") % 20 == 0, 1).otherwise(0)
    return ev.select(
        "event_id", F.when(F.col("event_id") % 50 != 7, F.col("event_epoch")).alias("event_epoch"),
        F.least(F.lit(3), quarter + late).cast("int").alias("arrival"))


# ------------------------------------------------------------ F2 transactions
def transactions(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``stream.transactions.v1``: txn_id, amount, event_epoch (BIGINT seconds)."""
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    return o.select(
        _s("o_orderkey").alias("txn_id"),
        F.col("o_totalprice").alias("amount"),
        (_epoch_s("o_orderdate") + F.col("o_orderkey") % 86400).alias("event_epoch"),
    )


# -------------------------------------------------------------- F3 order log
def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``eventsourcing.orders.v1`` flattened to one wide row per event.

    Columns: aggregate_id, seq (log order within the aggregate), event_type,
    amount, customer, method, carrier, tracking, reason, event_epoch.
    """
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    base_epoch = _epoch_s("o_orderdate")

    created = o.select(
        F.col("o_orderkey").alias("aggregate_id"), F.lit(0).cast("bigint").alias("seq"),
        F.lit("OrderCreated").alias("event_type"), F.col("o_totalprice").alias("amount"),
        _s("o_custkey").alias("customer"), null_s.alias("method"), null_s.alias("carrier"),
        null_s.alias("tracking"), null_s.alias("reason"), base_epoch.alias("order_epoch"))
    # Lines that tie up to the price and flag make equal events, whatever their order.
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    paid = (li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                      "l_returnflag")
            .withColumn("seq", (F.lit(10) + F.row_number().over(w)).cast("bigint"))
            .join(o.select(F.col("o_orderkey").alias("l_orderkey"),
                           base_epoch.alias("order_epoch")), "l_orderkey")
            .select(F.col("l_orderkey").alias("aggregate_id"), "seq",
                    F.lit("PaymentReceived").alias("event_type"),
                    F.col("l_extendedprice").alias("amount"), null_s.alias("customer"),
                    F.col("l_returnflag").alias("method"), null_s.alias("carrier"),
                    null_s.alias("tracking"), null_s.alias("reason"), "order_epoch"))
    shipped = o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("aggregate_id"), F.lit(100).cast("bigint").alias("seq"),
        F.lit("OrderShipped").alias("event_type"), null_d.alias("amount"), null_s.alias("customer"),
        null_s.alias("method"), F.col("o_orderpriority").alias("carrier"),
        F.concat(F.lit("TRK"), _s("o_orderkey")).alias("tracking"), null_s.alias("reason"),
        base_epoch.alias("order_epoch"))
    cancelled = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0)).select(
        F.col("o_orderkey").alias("aggregate_id"), F.lit(5).cast("bigint").alias("seq"),
        F.lit("OrderCancelled").alias("event_type"), null_d.alias("amount"),
        null_s.alias("customer"), null_s.alias("method"), null_s.alias("carrier"),
        null_s.alias("tracking"), F.lit("test").alias("reason"), base_epoch.alias("order_epoch"))
    return (created.unionByName(paid).unionByName(shipped).unionByName(cancelled)
            .withColumn("event_epoch", F.col("order_epoch") + F.col("seq") * 60)
            .drop("order_epoch"))


# ----------------------------------------------------------------- F4 CDC log
def _row(id_c: Column, cust: Column, status: Column, amount: Column) -> Column:
    return F.struct(id_c.alias("id"), cust.alias("customer"), status.alias("status"),
                    amount.alias("amount"))


def cdc_log(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``cdc.orders.v1`` change envelopes: off, op, before, after, source, ts_ms.

    Per order: a create, an update for non-open orders, a delete for every
    tenth order, and an unknown ``t`` op (ignored by the applier) for every
    97th one.
    """
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    k, cust, amt = F.col("o_orderkey"), _s("o_custkey"), F.col("o_totalprice")
    new_status = F.when(F.col("o_orderstatus") == "F", "SHIPPED").otherwise("PAID")
    last_status = F.when(F.col("o_orderstatus") == "O", "NEW").otherwise(new_status)
    null_row = F.lit(None).cast("struct<id:bigint,customer:string,status:string,amount:double>")
    base_ms = F.floor(epoch_micros("o_orderdate") / F.lit(1000)).cast("bigint")
    parts = [
        o.select((k * 10).alias("off"), F.lit("c").alias("op"), null_row.alias("before"),
                 _row(k, cust, F.lit("NEW"), amt).alias("after"), base_ms.alias("ts_ms")),
        o.filter(F.col("o_orderstatus") != "O").select(
            (k * 10 + 1).alias("off"), F.lit("u").alias("op"),
            _row(k, cust, F.lit("NEW"), amt).alias("before"),
            _row(k, cust, new_status, amt).alias("after"), (base_ms + 1000).alias("ts_ms")),
        o.filter(k % 10 == 0).select(
            (k * 10 + 2).alias("off"), F.lit("d").alias("op"),
            _row(k, cust, last_status, amt).alias("before"), null_row.alias("after"),
            (base_ms + 2000).alias("ts_ms")),
        o.filter(k % 97 == 0).select(
            (k * 10 + 3).alias("off"), F.lit("t").alias("op"), null_row.alias("before"),
            null_row.alias("after"), (base_ms + 3000).alias("ts_ms")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("source", F.struct(F.lit("orders").alias("table"),
                                             F.col("ts_ms").alias("ts_ms")))


def snapshot_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderkey") % 10 != 1).select(
        F.col("o_orderkey").alias("id"), _s("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))


def snapshot_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderkey") % 10 != 0).select(
        F.col("o_orderkey").alias("id"), _s("o_custkey").alias("customer"),
        F.when(F.col("o_orderkey") % 4 == 0, "SHIPPED").otherwise(F.col("o_orderstatus"))
        .alias("status"), F.col("o_totalprice").alias("amount"))


# ------------------------------------------------------------ F5 raw orders
def raw_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """``dlq.orders.v1`` as a log: off, key, value (BINARY), topic, partition."""
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    k = _s("o_orderkey")
    m = F.col("o_orderkey") % 10
    value = (F.when(m == 0, F.lit("bad_message:{not-json"))
             .when(m == 1, F.concat(F.lit('{"order_id":"'), k, F.lit('","customer":"x"}')))
             .when(m == 2, F.lit("[1,2]"))
             .when(m == 3, F.concat(F.lit('{"order_id":"'), k, F.lit('","note":"extra"}')))
             .when(m == 4, F.concat(F.lit('{"order_id":"'), k,
                                    F.lit('","customer":null,"amount":1}')))
             .otherwise(F.concat(F.lit('{"order_id":"'), k, F.lit('","customer":"c'),
                                 _s("o_custkey"), F.lit('","amount":'),
                                 _money_text("o_totalprice"), F.lit("}"))))
    return o.select(F.col("o_orderkey").alias("off"), k.alias("key"),
                    F.encode(value, "UTF-8").alias("value"),
                    F.lit("dlq.orders.v1").alias("topic"),
                    (F.col("o_orderkey") % 3).cast("int").alias("partition"))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pubsub.orders.v1`` messages as JSON texts: off, value.  Of every eight, one has no
    payload, one a quantity as text, two bad lines, one an object for lines, one a null
    payload and one no lines."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m = F.floor(k / 4) % 8
    quantity = F.when(m == 2, F.lit('"3"')).otherwise(_s(k % 7 + 1))
    payload = (F.when(m == 1, "").when(m == 6, ',"payload":null')
               .otherwise(F.concat(F.lit(',"payload":{"product":"SKU-'), _s(k % 20), F.lit('","quantity":'),
                                   quantity, F.lit(',"amount":'), _money_text("o_totalprice"), F.lit("}"))))
    lines = (F.when(m == 3, ',"lines":[{"sku":"a","qty":1},{"sku":"b","qty":true}]')
             .when(m == 4, ',"lines":[{"qty":2},{"sku":"c","qty":"x"}]')
             .when(m == 5, ',"lines":{}').when(m == 7, "").otherwise(',"lines":[{"sku":"a","qty":1}]'))
    return o.select(k.alias("off"), F.concat(F.lit('{"id":'), _s(k), payload, lines, F.lit("}")).alias("value"))


# -------------------------------------------------------- serde mixed log
def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed payloads for best-effort decoding: JSON objects, arrays, numbers,
    plain text, invalid UTF-8 bytes and nulls.  Columns: off, key, value."""
    ev = table(spark, sf_dir, "events")
    m = F.col("event_id") % 8
    et = F.col("event_type")
    text = (F.when(m == 1, F.col("props"))
            .when(m == 2, et)
            .when(m == 3, _money_text("value"))
            .when(m == 4, F.concat(F.lit("["), _s("user_id"), F.lit(',"'), et, F.lit('"]')))
            .when(m == 5, F.when(F.col("user_id") % 2 == 0, F.lit("true")).otherwise("null"))
            .when(m == 7, F.concat(F.lit('{"event_type":"'), et, F.lit('","value":'),
                                   _money_text("value"), F.lit("}"))))
    value = (F.when(m == 0, F.lit(None).cast("binary"))
             .when(m == 6, F.concat(F.unhex(F.lit("FFFE")), F.encode(et, "UTF-8")))
             .otherwise(F.encode(text, "UTF-8")))
    return ev.select(F.col("event_id").alias("off"), _s("user_id").alias("key"),
                     value.alias("value"))


# ------------------------------------------------------- F6 exactly-once
def transfers_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactional producer output: txn_id, transfer_id, seq, amount, off,
    ship_epoch.  Several rows per transfer act as redeliveries."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
        "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    return (li.withColumn("seq", F.row_number().over(w).cast("bigint"))
            .select(F.floor(F.col("l_orderkey") / 16).cast("bigint").alias("txn_id"),
                    _s("l_orderkey").alias("transfer_id"),
                    F.col("seq"),
                    (F.lit(100) * F.col("l_linenumber")).cast("bigint").alias("amount"),
                    (F.col("l_orderkey") * 16 + F.col("seq")).alias("off"),
                    _epoch_s("l_shipdate").alias("ship_epoch")))


def txn_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit markers: one ``commit`` row per committed transaction; aborted
    transactions (ids divisible by 7) have none."""
    li = table(spark, sf_dir, "lineitem")
    t = F.floor(F.col("l_orderkey") / 16).cast("bigint")
    return (li.select(t.alias("txn_id")).filter(F.col("txn_id") % 7 != 0).distinct()
            .withColumn("state", F.lit("commit")))


# ---------------------------------------------------------- F7 join inputs
def order_events(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    t = transactions(spark, sf_dir, orders)
    return t.select(F.col("txn_id").alias("order_id"), "amount",
                    F.col("event_epoch").alias("order_epoch"))


def payment_events(spark: SparkSession, sf_dir: str,
                   orders: DataFrame | None = None) -> DataFrame:
    t = transactions(spark, sf_dir, orders)
    oid = F.col("txn_id").cast("bigint")
    return t.filter(oid % 10 != 0).select(
        F.col("txn_id").alias("order_id"), "amount", F.lit("card").alias("method"),
        (F.col("event_epoch") + oid % 600).alias("payment_epoch"))


def payment_events_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 payments plus a second, later payment for every 7th order (repeats)."""
    p = payment_events(spark, sf_dir)
    oid = F.col("order_id").cast("bigint")
    again = p.filter(oid % 7 == 0).withColumn("payment_epoch", F.col("payment_epoch") + 120)
    return p.unionByName(again)


#: Every so many event ids the published amount is no number.
BAD_AMOUNT_EVERY = 97
_BEYOND = 9007199254740993      # 2**53 + 1


def _edge_key(oid):
    return (F.when(oid % 11 == 0, F.lit(None).cast("string")).when(oid % 13 == 0, F.lit(""))
            .otherwise((oid + _BEYOND).cast("string")))


def order_events_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 orders with keys beyond 2**53, null and empty keys, and for every 5th order a
    second one 200 s later: order_id, big, order_epoch."""
    o = order_events(spark, sf_dir)
    oid = F.col("order_id").cast("bigint")
    o = o.select(_edge_key(oid).alias("order_id"), (oid + _BEYOND).alias("big"), "order_epoch")
    later = o.filter((F.col("big") - _BEYOND) % 5 == 0) \
        .withColumn("order_epoch", F.col("order_epoch") + 200)
    return o.unionByName(later)


def payment_events_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 payments under the same keys, and for every 4th order one 100 s before the
    order: order_id, method, t."""
    p = payment_events(spark, sf_dir)
    oid = F.col("order_id").cast("bigint")
    p = p.withColumn("oid", oid).select(
        _edge_key(oid).alias("order_id"), "method", F.col("payment_epoch").alias("t"), "oid")
    early = p.filter(F.col("oid") % 4 == 0).withColumns(
        {"method": F.lit("early"), "t": F.col("t") - F.col("oid") % 600 - 100})
    return p.unionByName(early).drop("oid")


# ---------------------------------------------------- F8 delivery reports
def delivery_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer delivery reports: config, attempt, ok, latency_ms, n_bytes, sent_epoch."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("config"),
        F.col("l_linenumber").cast("bigint").alias("attempt"),
        (F.col("l_partkey") % 50 != 0).alias("ok"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("latency_ms"),
        F.lit(256).cast("bigint").alias("n_bytes"),
        (_epoch_s("l_shipdate") + F.col("l_linenumber")).alias("sent_epoch"))
