"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables through the fixture views and applies
one or more operators.  Column names match the SQL in
:mod:`logweave.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions import jsonschema, serde
from logweave.functions import transforms
from logweave.functions.materialize import computed
from logweave.functions.serde import header_value
from logweave.operators import cdc, dlq
from logweave.operators import eventsourcing as es
from logweave.operators import exactly_once as eo
from logweave.operators import joins
from logweave.operators import metrics
from logweave.operators import rolling
from logweave.operators import windows
from logweave.session import checkpoint_dir
from logweave.sources import fixtures as fx
from logweave.sources import logtable
from logweave.streaming import commits, jobs, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --------------------------------------------------------------- windows
@register("kpi_1m")
def kpi_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.kpi_windows(fx.analytics_events(spark, sf_dir), window_s=60)


@register("kpi_1h")
def kpi_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.kpi_windows(fx.analytics_events(spark, sf_dir), window_s=3600)


@register("kpi_1m_from_log")
def kpi_1m_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's path: events published as JSON messages, decoded
    best-effort, non-objects dropped, fields read with defaults, then KPIs."""
    good, _ = _kpi_messages(spark, sf_dir)
    return windows.kpi_windows(good, window_s=60)


@register("kpi_errors")
def kpi_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error output of :func:`kpi_1m_from_log`: purchases whose amount is no number."""
    _, bad = _kpi_messages(spark, sf_dir)
    return bad


def _kpi_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(events, rejected messages): a number that does not parse rejects its message,
    it never counts as 0."""
    ev = fx.analytics_events(spark, sf_dir)
    text = F.when(F.col("event_id").cast("bigint") % fx.BAD_AMOUNT_EVERY == 0, F.lit("n/a")) \
        .otherwise(F.col("amount").cast("string"))
    ev = ev.withColumn("amount", F.when(F.col("amount").isNotNull(), text))
    rec = logtable.to_records(ev, "analytics.events.v1", "user_id",
                              F.struct("event_id", "type", "user_id", "product", "event_epoch",
                                       "amount"),
                              F.col("event_epoch"))
    d = logtable.decode_messages(rec.select("timestamp", "value"), out="d")
    v = F.col("d.json")
    wrong = lambda f: serde.has_field(v, f) & serde.to_number(v, f).isNull()
    msgs = d.filter(serde.is_object(v)).select(
        serde.get_or_default(v, "event_id", "bigint", -1).alias("event_id"),
        serde.get_or_default(v, "type", "string", "page_view").alias("type"),
        F.when(serde.has_field(v, "event_epoch"), serde.to_number(v, "event_epoch"))
        .otherwise(F.unix_micros("timestamp") / F.lit(1e6)).alias("event_epoch"),
        F.coalesce(serde.to_number(v, "amount"), F.lit(0.0)).alias("amount"),
        serde.get_or_default(v, "amount", "string", "").alias("amount_text"),
        wrong("event_epoch").alias("_e"), wrong("amount").alias("_a"))
    bad = F.col("_e") | (F.col("_a") & (F.col("type") == "purchase"))
    return (msgs.filter(~bad).select("type", "event_epoch", "amount"),
            msgs.filter(bad).select("event_id", "type", F.col("amount_text").alias("amount")))


@register("sales_tumbling_30s")
def sales_tumbling_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_sales(fx.transactions(spark, sf_dir), window_s=30)


# ------------------------------------------------------ transforms / rolling


@register("high_value_tier")
def high_value_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.high_value(fx.transactions(spark, sf_dir), stamp_col=None)


@register("rolling_snapshot")
def rolling_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_snapshot(fx.analytics_events(spark, sf_dir), window_s=60)


@register("rolling_snapshot_1d")
def rolling_snapshot_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_snapshot(fx.analytics_events(spark, sf_dir), window_s=86400)


@register("rolling_series")
def rolling_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_series(fx.analytics_events(spark, sf_dir), window_s=60)


@register("rolling_series_1h")
def rolling_series_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_series(fx.analytics_events(spark, sf_dir), window_s=3600)


@register("top_products")
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.top_products(fx.analytics_events(spark, sf_dir), k=5, window_s=60)


@register("top_products_1d")
def top_products_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.top_products(fx.analytics_events(spark, sf_dir), k=5, window_s=86400)


# ------------------------------------------------------------ event sourcing
# Fixed parameters of the replay queries (epoch seconds, aggregate id).
REPLAY_SINCE = 883612800    # 1998-01-01T00:00:00Z
REPLAY_UNTIL = 852076800    # 1997-01-01T00:00:00Z
ONE_ORDER = 8


@register("fold_all")
def fold_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.fold_states(fx.order_log(spark, sf_dir))


@register("fold_one")
def fold_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.rebuild_state(fx.order_log(spark, sf_dir), ONE_ORDER)


@register("event_history")
def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.event_history(fx.order_log(spark, sf_dir), ONE_ORDER)


@register("replay_since")
def replay_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.fold_states(es.since(fx.order_log(spark, sf_dir), REPLAY_SINCE))


@register("replay_until")
def replay_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.fold_states(es.until(fx.order_log(spark, sf_dir), REPLAY_UNTIL))


@register("whatif_drop_payments")
def whatif_drop_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return es.whatif_diff(fx.order_log(spark, sf_dir), "drop-payments")


# ----------------------------------------------------------------------- CDC


@register("cdc_apply")
def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.apply_changes(fx.cdc_log(spark, sf_dir), order_col="off")


@register("cdc_count")
def cdc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.replica_count(cdc.apply_changes(fx.cdc_log(spark, sf_dir), order_col="off"))


@register("cdc_diff")
def cdc_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cdc.snapshot_diff(fx.snapshot_old(spark, sf_dir), fx.snapshot_new(spark, sf_dir),
                          table=None)
    return d.select("op", F.coalesce("before.id", "after.id").alias("id"),
                    *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after")
                      for c in ("customer", "status", "amount")])


@register("cdc_status_change")
def cdc_status_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cdc.status_changes(fx.cdc_log(spark, sf_dir), "NEW", "SHIPPED")
    return d.select("off", F.col("after.id").alias("id"), F.col("after.amount").alias("amount"))


# ----------------------------------------------------------------------- DLQ
MAIN_TOPIC = "dlq.orders.v1"


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.dead_letters(dlq.classify(fx.raw_orders(spark, sf_dir)), MAIN_TOPIC)


@register("dlq_classify")
def dlq_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.classify(fx.raw_orders(spark, sf_dir)).select("off", "key", "error")


@register("dlq_route")
def dlq_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dlq_view(_dead(spark, sf_dir))


def _dlq_view(d: DataFrame) -> DataFrame:
    return d.select("key", F.col("value").cast("string").alias("value"),
                    *[header_value("headers", h).alias(h) for h in
                      ("error", "source_topic", "source_offset", "source_partition")])


@register("dlq_recover")
def dlq_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = dlq.recover(_dead(spark, sf_dir))
    return r.select("key", F.col("value").cast("string").alias("value"), "order_id",
                    "customer", "amount")


@register("dlq_poison")
def dlq_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = dlq.poison(_dead(spark, sf_dir))
    return p.select("key", F.col("value").cast("string").alias("value"), "error")


@register("dlq_counters")
def dlq_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.outcome_counts(fx.raw_orders(spark, sf_dir))


@register("dlq_reprocess")
def dlq_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq.reprocess_log(fx.raw_orders(spark, sf_dir))


# -------------------------------------------------------------- exactly once
LEDGER_CUTOFF = 852076800   # ship dates before 1997-01-01 were processed earlier


def _committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eo.read_committed(fx.transfers_staged(spark, sf_dir), fx.txn_markers(spark, sf_dir))


@register("read_committed")
def read_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _committed(spark, sf_dir).select("txn_id", "transfer_id", "seq", "amount", "off")


@register("dedup_first")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eo.first_occurrence(_committed(spark, sf_dir), "transfer_id", "off")


@register("dedup_counters")
def dedup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eo.dedup_counters(_committed(spark, sf_dir), "transfer_id")


@register("ledger_new")
def ledger_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed = _committed(spark, sf_dir)
    ledger = eo.first_occurrence(committed.filter(F.col("ship_epoch") < LEDGER_CUTOFF),
                                 "transfer_id", "off")
    return eo.apply_once(committed, ledger, "transfer_id", "off")


# --------------------------------------------------------------------- joins

JOIN_WINDOW_S = 300


def _consume(spark: SparkSession, sf_dir: str, payments: DataFrame) -> DataFrame:
    return joins.consume_on_match(fx.order_events(spark, sf_dir), payments, "order_id",
                                  "order_epoch", "payment_epoch", JOIN_WINDOW_S,
                                  left_order=["amount"], right_order=["amount", "method"])


def _joined(df: DataFrame) -> DataFrame:
    return df.filter("matched").select(
        F.col("key").alias("order_id"), F.col("l_amount").alias("order_amount"),
        F.col("r_amount").alias("payment_amount"), F.col("r_method").alias("method"),
        F.col("l_order_epoch").alias("order_epoch"),
        F.col("r_payment_epoch").alias("payment_epoch"))


@register("order_payment_join")
def order_payment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_consume(spark, sf_dir, fx.payment_events(spark, sf_dir)))


@register("order_unpaid")
def order_unpaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _consume(spark, sf_dir, fx.payment_events(spark, sf_dir))
    return c.filter(~F.col("matched")).select(
        F.col("key").alias("order_id"), F.col("l_amount").alias("amount"),
        F.col("l_order_epoch").alias("order_epoch"))


@register("order_payment_consume")
def order_payment_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_consume(spark, sf_dir, fx.payment_events_repeated(spark, sf_dir)))


@register("interval_join")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = joins.interval_join(fx.order_events(spark, sf_dir),
                            fx.payment_events_repeated(spark, sf_dir), "order_id",
                            "order_epoch", "payment_epoch", JOIN_WINDOW_S)
    return j.select(F.col("_l.order_id").alias("order_id"),
                    F.col("_l.amount").alias("order_amount"),
                    F.col("_r.amount").alias("payment_amount"), F.col("_r.method").alias("method"),
                    F.col("_l.order_epoch").alias("order_epoch"),
                    F.col("_r.payment_epoch").alias("payment_epoch"))


@register("interval_unmatched")
def interval_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.unmatched(fx.order_events(spark, sf_dir), fx.payment_events(spark, sf_dir),
                           "order_id", "order_epoch", "payment_epoch", JOIN_WINDOW_S)


@register("order_consume_edges")
def order_consume_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consume-on-match over records without key, superseded orders, early payments
    and ids beyond the whole numbers of a double."""
    c = joins.consume_on_match(fx.order_events_edges(spark, sf_dir),
                               fx.payment_events_edges(spark, sf_dir), "order_id",
                               "order_epoch", "t", JOIN_WINDOW_S,
                               right_order=["method"])
    return c.filter("matched").select(
        F.col("key").alias("order_id"), F.col("l_big").alias("big"),
        F.col("l_order_epoch").alias("order_epoch"), F.col("r_t").alias("payment_epoch"),
        F.col("r_method").alias("method"))


# ------------------------------------------------------------------- metrics


@register("delivery_metrics")
def delivery_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.delivery_metrics(fx.delivery_reports(spark, sf_dir))


@register("latency_percentiles")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latency_report(fx.delivery_reports(spark, sf_dir))


@register("throughput_by_config")
def throughput_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.throughput_summary(fx.delivery_reports(spark, sf_dir))


@register("bench_report")
def bench_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bench_report(metrics.throughput_summary(fx.delivery_reports(spark, sf_dir)))


# --------------------------------------------------------------------- serde

# Fixed value: the order schema checked by ``schema_errors``.
ORDER_SCHEMA = {
    "type": "object",
    "required": ["order_id", "customer", "amount"],
    "properties": {"order_id": {"type": "string"}, "customer": {"type": "string"},
                   "amount": {"type": "number"}},
}


@register("decode_best_effort")
def decode_best_effort(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = logtable.decode_messages(fx.raw_messages(spark, sf_dir).select("off", "value"),
                                 out="d")
    return d.select("off", F.col("d.kind").alias("kind"), F.col("d.text").alias("text"),
                    serde.json_kind(F.col("d.json")).alias("json_kind"))


@register("encode_json")
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.transactions(spark, sf_dir)
    return t.select("txn_id", serde.encode_value(F.struct("txn_id", "amount", "event_epoch"))
                    .cast("string").alias("value"))


@register("field_defaults")
def field_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_orders(spark, sf_dir)
    v = serde.parse_json(F.col("value").cast("string"))
    objs = computed(raw, {"_v": v}).filter(serde.is_object(F.col("_v")))
    return objs.select("off",
                       serde.get_or_default(F.col("_v"), "order_id", "string", "recovered")
                       .alias("order_id"),
                       serde.get_or_default(F.col("_v"), "customer", "string", "unknown")
                       .alias("customer"),
                       serde.get_or_default(F.col("_v"), "amount", "double", 0.0)
                       .alias("amount"))


@register("type_projection")
def type_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.order_log(spark, sf_dir).withColumn("aggregate_id",
                                                 F.col("aggregate_id").cast("string"))
    enc = es.events_to_json(log).select("seq", "value")
    dec = es.events_from_json(enc)
    return dec.select("aggregate_id", "seq", "event_type", "customer", "amount", "method",
                      "carrier", "tracking", "reason")


@register("schema_errors")
def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_orders(spark, sf_dir)
    v = serde.parse_json(F.col("value").cast("string"))
    ok = computed(raw, {"_v": v}).filter(F.col("_v").isNotNull())
    errs = jsonschema.compile_errors(F.col("_v"), ORDER_SCHEMA)
    return ok.select("off", F.size(errs).cast("bigint").alias("n_errors"),
                     F.array_join(errs, "; ").alias("errors"))


# Fixed value: the nested order message checked by ``schema_errors_nested``.
NESTED_SCHEMA = {
    "type": "object", "required": ["id", "payload"],
    "properties": {
        "id": {"type": "integer"},
        "payload": {"type": "object", "properties": {
            "product": {"type": "string"}, "quantity": {"type": "integer"}, "amount": {"type": "number"}}},
        "lines": {"type": "array", "items": {
            "type": "object", "required": ["sku"], "properties": {"qty": {"type": "integer"}}}}},
}


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return computed(fx.nested_orders(spark, sf_dir), {"_v": serde.parse_json("value")})


@register("nested_fields")
def nested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of members (FN7); null where the way there ends."""
    v = F.col("_v")
    return _nested(spark, sf_dir).select(
        "off", serde.nested(v, "payload.product", "string").alias("product"),
        serde.nested(v, "payload.quantity", "bigint").alias("quantity"),
        serde.nested(v, "payload.amount", "double").alias("amount"))


@register("schema_errors_nested")
def schema_errors_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects and array items (FN16)."""
    errs = jsonschema.compile_errors(F.col("_v"), NESTED_SCHEMA)
    return _nested(spark, sf_dir).select("off", F.array_join(errs, "; ").alias("errors"))


@register("tax_inclusive")
def tax_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gross amounts at a rate of 19 % (FN21)."""
    t = transforms.tax_inclusive(fx.transactions(spark, sf_dir), 0.19)
    return t.select("txn_id", "amount", "amount_incl")


# ----------------------------------------------------------------- log table
TXN_TOPIC = "stream.transactions.v1"


def _txn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.transactions(spark, sf_dir)
    rec = logtable.to_records(t, TXN_TOPIC, "txn_id", F.struct("txn_id", "amount", "event_epoch"),
                              F.col("event_epoch"),
                              partition=F.pmod(F.col("txn_id").cast("bigint"), F.lit(3)))
    return logtable.assign_offsets(rec)


@register("message_metadata")
def message_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logtable.metadata(_txn_log(spark, sf_dir), {"txn_id": "string", "amount": "double"})


@register("consume_first_n")
def consume_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = logtable.first_n(_txn_log(spark, sf_dir), 100)
    return first.select(serde.decode_key("key").alias("key"), "partition", "offset")


# Fixed parameter: the moment a "latest" consumer starts (2000-01-01T00:00:00Z).
LATEST_FROM = 946684800


@register("log_write_read")
def log_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written to a log directory in the shared folder, then read back."""
    path = sinks.scratch_path(checkpoint_dir(spark), "txn-log")
    logtable.write_log(_txn_log(spark, sf_dir), path)
    return logtable.metadata(logtable.read_log(spark, path, [TXN_TOPIC]),
                             {"txn_id": "string", "amount": "double"})


@register("consume_from_latest")
def consume_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer started with ``latest`` sees only records appended after the
    per-partition high-water marks of the log as it was when it started."""
    t = fx.transactions(spark, sf_dir)
    rec = logtable.to_records(t, TXN_TOPIC, "txn_id", F.struct("txn_id", "amount", "event_epoch"),
                              F.col("event_epoch"),
                              partition=F.pmod(F.col("txn_id").cast("bigint"), F.lit(3)))
    snapshot = logtable.assign_offsets(rec.filter(F.col("timestamp") <
                                                  F.lit(LATEST_FROM).cast("timestamp")))
    log = logtable.assign_offsets(rec)
    seen = logtable.starting_from(log, "latest", snapshot=snapshot)
    return seen.select(serde.decode_key("key").alias("key"), "partition", "offset")


@register("topic_union")
def topic_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.order_events(spark, sf_dir).select(
        F.lit("stream.order_events.v1").alias("topic"), F.col("order_id").alias("key"),
        "amount", F.col("order_epoch").alias("event_epoch"))
    p = fx.payment_events(spark, sf_dir).select(
        F.lit("stream.payment_events.v1").alias("topic"), F.col("order_id").alias("key"),
        "amount", F.col("payment_epoch").alias("event_epoch"))
    return logtable.union_topics(o, p)


ORDER_TOPIC, PAYMENT_TOPIC = "stream.order_events.v1", "stream.payment_events.v1"


def _two_topic_log(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Orders and payments as one log directory, routed by key; its path."""
    parts = [logtable.to_records(df, topic, "order_id", F.struct("order_id", "amount"),
                                 F.col(t), num_partitions=6)
             for df, topic, t in ((fx.order_events(spark, sf_dir), ORDER_TOPIC, "order_epoch"),
                                  (fx.payment_events(spark, sf_dir), PAYMENT_TOPIC,
                                   "payment_epoch"))]
    path = sinks.scratch_path(checkpoint_dir(spark), name)
    logtable.write_log(logtable.assign_offsets(logtable.union_topics(*parts)), path)
    return path


@register("log_key_routing")
def log_key_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key of both topics lies in one partition number."""
    log = logtable.read_log(spark, _two_topic_log(spark, sf_dir, "routed-log"))
    return log.groupBy(serde.decode_key("key").alias("key")).agg(
        F.count_distinct("partition").alias("n_partitions"), F.count("*").alias("n_records"))


@register("stream_subscribe")
def stream_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription to two topics, a few files per micro-batch."""
    path = _two_topic_log(spark, sf_dir, "subscribed-log")
    log = logtable.read_log_stream(spark, path, [ORDER_TOPIC, PAYMENT_TOPIC],
                                   max_files_per_trigger=6)
    d = logtable.decode_messages(log, out="d")
    out = d.select("topic", serde.decode_key("key").alias("key"),
                   serde.to_number(F.col("d.json"), "amount").alias("amount"),
                   F.unix_seconds("timestamp").alias("event_epoch"))
    return jobs.run_available(out, "stream_subscribe")


@register("stream_fanout")
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two groups over one log, each with its own checkpoint and offsets."""
    path = _two_topic_log(spark, sf_dir, "fanout-log")
    seen = [jobs.run_available(
        logtable.read_log_stream(spark, path, topics).select(F.lit(grp).alias("grp"), "topic"),
        f"fanout-{grp}") for grp, topics in (("audit", [ORDER_TOPIC, PAYMENT_TOPIC]),
                                             ("billing", [PAYMENT_TOPIC]))]
    return seen[0].unionByName(seen[1]).groupBy("grp", "topic").agg(F.count("*").alias("n"))


# ----------------------------------------------------------------- streaming


@register("stream_kpi")
def stream_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.analytics_events(spark, sf_dir, ev=fx.table_stream(spark, sf_dir, "events"))
    return jobs.run_available(jobs.kpi_stream(ev, window_s=60), "stream_kpi")


@register("stream_rolling")
def stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.analytics_events(spark, sf_dir, ev=fx.table_stream(spark, sf_dir, "events"))
    live = jobs.rolling_stream(ev, window_s=60, slide_s=10)
    return jobs.run_available(live, "stream_rolling").select(
        F.unix_seconds("w.start").alias("window_start"), "window_count", "page_views", "purchases")


@register("stream_join")
def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.order_events(spark, sf_dir, orders=fx.table_stream(spark, sf_dir, "orders"))
    p = fx.payment_events(spark, sf_dir, orders=fx.table_stream(spark, sf_dir, "orders"))
    j = jobs.join_stream(o, p, bound_s=JOIN_WINDOW_S)
    out = j.select(F.col("o.order_id").alias("order_id"),
                   F.col("o.amount").alias("order_amount"),
                   F.col("p.amount").alias("payment_amount"), F.col("p.method").alias("method"),
                   F.col("o.order_epoch").alias("order_epoch"),
                   F.col("p.payment_epoch").alias("payment_epoch"))
    return jobs.run_available(out, "stream_join")


@register("stream_dedup")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_dedup")
    # Transactional producer (EO1): staged rows first, commit markers last.
    fx.transfers_staged(spark, sf_dir).write.parquet(f"{root}/staged")
    fx.txn_markers(spark, sf_dir).write.parquet(f"{root}/markers")
    staged = spark.readStream.schema(spark.read.parquet(f"{root}/staged").schema) \
        .parquet(f"{root}/staged")
    markers = spark.read.parquet(f"{root}/markers")
    return jobs.dedup_stream(spark, staged, markers, "transfer_id", f"{root}/ledger",
                             f"{root}/batches")


@register("stream_cdc")
def stream_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_cdc")
    changes = fx.cdc_log(spark, sf_dir, orders=fx.table_stream(spark, sf_dir, "orders"))
    jobs.run_foreach(changes, "stream_cdc",
                     sinks.cdc_replica_sink(f"{root}/replica", f"{root}/batches"))
    return sinks.read_replica(spark, f"{root}/replica", f"{root}/batches")


@register("stream_dlq")
def stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_dlq")
    raw = fx.raw_orders(spark, sf_dir, orders=fx.table_stream(spark, sf_dir, "orders"))
    jobs.run_foreach(raw, "stream_dlq", sinks.dlq_router(f"{root}/main", f"{root}/dlq",
                                                         f"{root}/batches", MAIN_TOPIC))
    return _dlq_view(sinks.read_table(spark, "dlq", f"{root}/dlq", f"{root}/batches"))


def _halves(df: DataFrame, path: str):
    """Write ``df`` to a log folder in two appends, the later offsets second; yields the
    stream over the folder after each."""
    spark = df.sparkSession
    cut = (F.col("off") * 2 <= F.lit(df.agg(F.max("off")).first()[0] or 0))
    for part in (df.filter(cut), df.filter(~cut)):
        part.write.mode("append").parquet(path)
        yield spark.readStream.schema(df.schema).parquet(path)


@register("stream_dedup_restart")
def stream_dedup_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_dedup`` stopped halfway and started again on its checkpoint."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_dedup_restart")
    markers = fx.txn_markers(spark, sf_dir)
    for staged in _halves(fx.transfers_staged(spark, sf_dir), f"{root}/staged"):
        ledger = jobs.dedup_stream(spark, staged, markers, "transfer_id", f"{root}/ledger",
                                   f"{root}/batches", checkpoint=f"{root}/checkpoint")
    return ledger


@register("stream_cdc_restart")
def stream_cdc_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_cdc`` stopped halfway and started again under a new checkpoint: changes
    that the replica has already are applied a second time and change nothing."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_cdc_restart")
    for i, changes in enumerate(_halves(fx.cdc_log(spark, sf_dir), f"{root}/changes")):
        jobs.run_foreach(changes, "stream_cdc_restart",
                         sinks.cdc_replica_sink(f"{root}/replica", f"{root}/batches"),
                         checkpoint=f"{root}/checkpoint-{i}")
    return sinks.read_replica(spark, f"{root}/replica", f"{root}/batches")


#: Rows of a slice that one file takes; more rows make more files, and so more tasks.
ROWS_PER_FILE = 500_000


def _slices(df: DataFrame, path: str, n: int, slice_no: Column, files: int = 2):
    """Write ``df`` to a log folder in ``n`` appends, the rows of a slice together; yields after
    each the number of files of a slice.  It is the same for all slices (at least ``files``, and
    one per ``ROWS_PER_FILE`` rows of the largest; a small slice gets empty files), so read with
    ``maxFilesPerTrigger`` of it a slice is a batch."""
    spark = df.sparkSession
    df = df.withColumn("_slice", slice_no).persist()
    try:
        rows = df.agg(*[F.count_if(F.col("_slice") == i) for i in range(n)]).first()
        files = max(files, -(-max(rows) // ROWS_PER_FILE))
        for i in range(n):
            part = df.filter(F.col("_slice") == i).drop("_slice")
            part.repartition(files).write.mode("append").parquet(path)
            there = len(spark.read.schema(part.schema).parquet(path).inputFiles())
            for _ in range(files * (i + 1) - there):
                spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").parquet(path)
            yield files
    finally:
        df.unpersist()


def _stream_of(spark: SparkSession, path: str, like: DataFrame, files: int) -> DataFrame:
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


@register("stream_late_split")
def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows kept apart (STR4): events arrive by quarters of their time span, every
    20th one quarter late, some without a time; stopped and started again halfway."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_late_split")
    log = fx.arriving_events(spark, sf_dir)
    for i, files in enumerate(_slices(log, f"{root}/log", 4, F.col("arrival"))):
        if i % 2:
            live = jobs.tag_late(_stream_of(spark, f"{root}/log", log, files), delay="2 seconds", window_s=60)
            jobs.run_foreach(live, "stream_late_split", sinks.late_split_sink(
                f"{root}/main", f"{root}/late", f"{root}/commits"), checkpoint=f"{root}/checkpoint")
    parts = [sinks.read_table(spark, name, f"{root}/{name}", f"{root}/commits")
             .withColumn("late", F.lit(name == "late")) for name in ("main", "late")]
    return parts[0].unionByName(parts[1]).select("event_id", "event_epoch", "late")


@register("stream_cdc_bucketed")
def stream_cdc_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert store (SNK4) fed out of order: updates and deletes first, creates after them,
    then everything once more under a new checkpoint."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_cdc_bucketed")
    log = fx.cdc_log(spark, sf_dir)
    order = F.when(F.col("op") == "c", 1).otherwise(0)
    files = max(_slices(log, f"{root}/changes", 2, order))
    for run in range(2):
        jobs.run_foreach(_stream_of(spark, f"{root}/changes", log, files), "stream_cdc_bucketed",
                         sinks.cdc_replica_sink(f"{root}/replica", f"{root}/commits"),
                         checkpoint=f"{root}/checkpoint-{run}")
    return sinks.read_replica(spark, f"{root}/replica", f"{root}/commits")


def _order_payment_stream(spark: SparkSession, sf_dir: str, name: str, payments: DataFrame) -> DataFrame:
    """Orders and payments as one time-ordered log in four micro-batches, joined as a stream."""
    root = sinks.scratch_path(checkpoint_dir(spark), name)
    o = fx.order_events(spark, sf_dir).withColumnRenamed("order_epoch", "t")
    log = o.withColumn("method", F.lit(None).cast("string")).withColumn("side", F.lit(0)).unionByName(
        payments.withColumnRenamed("payment_epoch", "t").withColumn("side", F.lit(1)))
    span = log.agg(F.min("t"), F.max("t") + 1).first()
    quarter = F.floor(4 * (F.col("t") - F.lit(span[0])) / F.lit((span[1] or 1) - (span[0] or 0)))
    files = max(_slices(log, f"{root}/log", 4, quarter))
    side = lambda n, t, *cols: _stream_of(spark, f"{root}/log", log, files).filter(F.col("side") == n) \
        .select("order_id", "amount", F.col("t").alias(t), *cols)
    live = jobs.consume_stream(side(0, "order_epoch"), side(1, "payment_epoch", "method"),
                               bound_s=JOIN_WINDOW_S)
    return jobs.run_available(live, name)


def _member(col: str, name: str, kind: str) -> Column:
    return F.get_json_object(col, f"$.{name}").cast(kind)


@register("stream_consume")
def stream_consume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_payment_consume`` as a stream over several micro-batches."""
    out = _order_payment_stream(spark, sf_dir, "stream_consume", fx.payment_events_repeated(spark, sf_dir))
    return out.filter("matched").select(
        F.col("key").alias("order_id"), _member("order_json", "amount", "double").alias("order_amount"),
        _member("payment_json", "amount", "double").alias("payment_amount"),
        _member("payment_json", "method", "string").alias("method"),
        F.col("order_t").cast("bigint").alias("order_epoch"),
        F.col("payment_t").cast("bigint").alias("payment_epoch"))


@register("stream_expiry")
def stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that the watermark expires without a payment (JN4)."""
    out = _order_payment_stream(spark, sf_dir, "stream_expiry", fx.payment_events(spark, sf_dir))
    return out.filter("NOT matched").select(
        F.col("key").alias("order_id"), _member("order_json", "amount", "double").alias("amount"),
        F.col("order_t").cast("bigint").alias("order_epoch"))


@register("stream_fold")
def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fold_all`` kept up to date over four batches (AG5); each batch holds events of many
    orders, and later events of an order may come before earlier ones."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_fold")
    log = fx.order_log(spark, sf_dir)
    files = max(_slices(log, f"{root}/log", 4, ((F.col("seq") + 3) % 4).cast("int")))
    jobs.run_foreach(_stream_of(spark, f"{root}/log", log, files), "stream_fold", sinks.fold_sink(
        f"{root}/events", f"{root}/states", f"{root}/commits"))
    return sinks.read_states(spark, f"{root}/states", f"{root}/commits")


@register("ledger_indexed")
def ledger_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger in hash buckets with filters (SNK5), over four batches with redeliveries."""
    root = sinks.scratch_path(checkpoint_dir(spark), "ledger_indexed")
    staged = fx.transfers_staged(spark, sf_dir)
    top = staged.agg(F.max("off")).first()[0] or 0
    part = F.least(F.lit(3), F.floor(4 * F.col("off") / F.lit(top + 1))).cast("int")
    files = max(_slices(staged, f"{root}/staged", 4, part))
    return jobs.dedup_stream(spark, _stream_of(spark, f"{root}/staged", staged, files),
                             fx.txn_markers(spark, sf_dir), "transfer_id", f"{root}/ledger",
                             f"{root}/commits")


@register("stream_from_latest")
def stream_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group started at ``latest`` (SRC3), stopped, and started again after more records."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_from_latest")
    log = _txn_log(spark, sf_dir)
    old = F.col("timestamp") < F.lit(LATEST_FROM).cast("timestamp")
    for part in (log.filter(old), log.filter(~old)):
        logtable.write_log(part, f"{root}/log")
        live = logtable.read_log_stream_latest(spark, f"{root}/log", f"{root}/start", [TXN_TOPIC])
        got = jobs.run_available(live.select(serde.decode_key("key").alias("key"), "partition", "offset"),
                                 "stream_from_latest", out=f"{root}/out", checkpoint=f"{root}/checkpoint")
    return got


def _recovery(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The DLQ processor over the dead letters of ``raw_orders``, stopped halfway; its folder."""
    root = sinks.scratch_path(checkpoint_dir(spark), name)
    raw = fx.raw_orders(spark, sf_dir)
    checked = dlq.classify(raw)
    part = F.pmod(F.col("key").cast("bigint"), F.lit(3)).cast("int")
    main = logtable.to_records(dlq.valid_rows(checked), MAIN_TOPIC, "key", F.col("value"),
                               F.timestamp_seconds("off"), part)
    main = logtable.assign_offsets(main)
    dead = dlq.dead_letters(checked, MAIN_TOPIC).withColumn(
        "off", header_value("headers", "source_offset").cast("bigint"))
    for live in _halves(dead, f"{root}/dlq"):
        jobs.run_foreach(live, name, sinks.dlq_recovery_sink(
            f"{root}/main", f"{root}/poison", f"{root}/commits", MAIN_TOPIC, main, part),
            checkpoint=f"{root}/checkpoint")
    return root


@register("stream_dlq_recover")
def stream_dlq_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered dead letters with the offsets they get in the main topic (ST2)."""
    root = _recovery(spark, sf_dir, "stream_dlq_recover")
    return sinks.read_table(spark, "recovered", f"{root}/main", f"{root}/commits").select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset")


@register("stream_poison")
def stream_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The poison table (DLQ4)."""
    root = _recovery(spark, sf_dir, "stream_poison")
    return sinks.read_table(spark, "poison", f"{root}/poison", f"{root}/commits").select(
        "key", F.col("value").cast("string").alias("value"), "error")


@register("stream_counters")
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the DLQ router (AG6, UDF3) over two batches, the second after a restart."""
    root = sinks.scratch_path(checkpoint_dir(spark), "stream_counters")
    for live in _halves(fx.raw_orders(spark, sf_dir), f"{root}/log"):
        jobs.run_foreach(live, "stream_counters", sinks.dlq_router(
            f"{root}/main", f"{root}/dlq", f"{root}/commits", MAIN_TOPIC), checkpoint=f"{root}/checkpoint")
    return sinks.counters(spark, f"{root}/commits")


@register("publish_fenced")
def publish_fenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer that is replaced while it still runs: what it publishes afterwards is refused,
    and its successor publishes the same transaction once (EO4)."""
    root = sinks.scratch_path(checkpoint_dir(spark), "publish_fenced")
    rows = fx.transfers_staged(spark, sf_dir).drop("txn_id")
    odd = rows.filter(F.col("off") % 2 == 1)
    first = commits.TransactionalWriter(spark, root, "transfers")
    first.publish(rows.filter(F.col("off") % 2 == 0), 0)
    second = commits.TransactionalWriter(spark, root, "transfers")
    try:
        first.publish(odd, 1)
    except commits.Fenced:
        second.publish(odd, 1)
        second.publish(odd, 1)
    second.publish(rows, 2, abort=True)
    return commits.read_published(spark, root).select(
        "txn_id", "epoch", "transfer_id", "seq", "amount", "off")


@register("bench_report_full")
def bench_report_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report document from result files (SNK8)."""
    root = sinks.scratch_path(checkpoint_dir(spark), "bench_report_full")
    sent = fx.delivery_reports(spark, sf_dir)
    sweep = metrics.throughput_summary(sent).agg(F.to_json(F.array_sort(F.collect_list(F.struct(
        "config", "count", "elapsed_s", "msg_per_s", "mb_per_s")))))        # one row per configuration
    lat = metrics.latency_report(sent, ()).select(F.to_json(F.struct("*")))
    for df, name in ((sweep, "throughput"), (lat, "latency")):
        df.coalesce(1).write.text(f"{root}/{name}.json")
    return metrics.report_document(spark, f"{root}/throughput.json", f"{root}/latency.json")


@register("publish_atomic_retry")
def publish_atomic_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two transactions published after an attempt that never committed, then again
    after they did; a third one is aborted.  Readers see each row once."""
    root = sinks.scratch_path(checkpoint_dir(spark), "publish_atomic_retry")
    rows = fx.transfers_staged(spark, sf_dir).drop("txn_id")
    log, marks = f"{root}/staged", f"{root}/markers"
    for txn in (0, 1):
        mine = rows.filter(F.col("off") % 2 == txn)
        eo.publish_atomic(mine.filter(F.col("off") % 3 == 0), txn, log, marks, commit=False)
        for _ in range(2):
            eo.publish_atomic(mine, txn, log, marks)
    eo.publish_atomic(rows, 2, log, marks, commit=False)
    return eo.read_committed(spark.read.parquet(log), spark.read.parquet(marks)).select(
        "txn_id", "transfer_id", "seq", "amount", "off")
