"""Event sourcing: fold an order's event log into its state (AG4, AG5,
WN1, WN2, FN11-FN15, JN5, SO2).

Fold rules, per aggregate in log order, from status ``UNKNOWN`` and paid 0:
``OrderCreated`` -> CREATED and sets amount; ``PaymentReceived`` -> paid +=
amount, and PAID only if paid >= the amount known so far (0 if none);
``OrderShipped`` -> SHIPPED; ``OrderCancelled`` -> CANCELLED; other types
leave the state alone.

``fold_states`` never needs a per-aggregate window for ordinary logs: with
non-negative payments, running paid only grows and the amount cannot change
after the last status-setting event L, so the final status is PAID exactly
when a payment follows L and total paid >= the last created amount; else it
is L's status.  That is one partial aggregation (map-side combine, so a hot
aggregate is pre-reduced in every task before the shuffle).  Aggregates with
a negative payment take an exact path built on a segmented scan, which also
splits a hot aggregate over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logweave.functions.numeric import MONEY
from logweave.operators.scan import segmented_scan

# Event type names and the statuses they set.
CREATED = "OrderCreated"
PAYMENT = "PaymentReceived"
SHIPPED = "OrderShipped"
CANCELLED = "OrderCancelled"
STATUS_OF = {CREATED: "CREATED", SHIPPED: "SHIPPED", CANCELLED: "CANCELLED"}

# Wide event schema (FN11): base fields + every subclass field, nullable.
EVENT_SCHEMA = T.StructType([
    T.StructField("aggregate_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("customer", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("method", T.StringType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("tracking", T.StringType()),
    T.StructField("reason", T.StringType()),
])
# Fields each concrete class accepts; unknown types fall back to the base.
CLASS_FIELDS = {
    CREATED: ("customer", "amount"),
    PAYMENT: ("amount", "method"),
    SHIPPED: ("carrier", "tracking"),
    CANCELLED: ("reason",),
}
SUBCLASS_FIELDS = ("customer", "amount", "method", "carrier", "tracking", "reason")


def _status_of_place(i: Column) -> Column:
    out = None
    for n, v in enumerate(STATUS_OF.values()):
        out = F.when(i == n, v) if out is None else out.when(i == n, v)
    return out


# ----------------------------------------------------------- serde (FN11/12)
def events_from_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Type-directed projection of JSON events (FN11): fields a class does not
    declare are nulled; unknown event types keep only the base fields."""
    parsed = F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA)
    out = df.withColumn("_e", parsed)
    et = F.col("_e.event_type")
    cols = [F.col("_e.aggregate_id").alias("aggregate_id"),
            F.coalesce(et, F.lit("Event")).alias("event_type"),
            F.col("_e.timestamp").alias("timestamp")]
    for f in SUBCLASS_FIELDS:
        owners = [k for k, v in CLASS_FIELDS.items() if f in v]
        cols.append(F.when(et.isin(owners), F.col(f"_e.{f}")).alias(f))
    keep = [c for c in df.columns if c != value_col]
    return out.select(*keep, *cols)


def events_to_json(df: DataFrame, out_col: str = "value") -> DataFrame:
    """Event row -> JSON object with the discriminator, nulls dropped (FN12)."""
    fields = ["aggregate_id", "event_type", "timestamp", *SUBCLASS_FIELDS]
    present = [c for c in fields if c in df.columns]
    return df.withColumn(out_col, F.to_json(F.struct(*present),
                                            {"ignoreNullFields": "true"}))


# -------------------------------------------------------- selection (FN13-15)
def for_aggregate(df: DataFrame, aggregate_id, id_col: str = "aggregate_id") -> DataFrame:
    """Events of one aggregate (FN13); a plain filter, pushed into the scan."""
    return df.filter(F.col(id_col) == F.lit(aggregate_id))


def since(df: DataFrame, t, time_col: str = "event_epoch") -> DataFrame:
    """Replay from ``t`` inclusive (FN14)."""
    return df.filter(F.col(time_col) >= F.lit(t))


def until(df: DataFrame, t, time_col: str = "event_epoch") -> DataFrame:
    """State as of ``t`` inclusive (documented time travel)."""
    return df.filter(F.col(time_col) <= F.lit(t))


WHATIF: dict[str, Callable[[DataFrame], DataFrame]] = {
    "none": lambda df: df,
    "drop-payments": lambda df: df.filter(F.col("event_type") != PAYMENT),
}


def whatif(df: DataFrame, scenario: str) -> DataFrame:
    """Apply a registered hypothetical scenario (FN15); unknown -> ValueError."""
    try:
        return WHATIF[scenario](df)
    except KeyError:
        raise ValueError(f"Unknown what-if scenario: {scenario}") from None


# --------------------------------------------------------------- fold (AG5)
def _event_parts(seq_col: str) -> dict[str, Column]:
    """What one event adds to the fold.  The type goes as its place in ``STATUS_OF``: with
    numbers only, Spark aggregates by hashing and needs no sort."""
    et, amt, seq = F.col("event_type"), F.col("amount"), F.col(seq_col)
    is_c, is_p = et == CREATED, et == PAYMENT
    place = None
    for i, k in enumerate(STATUS_OF):
        place = F.when(et == k, i) if place is None else place.when(et == k, i)
    return {"_paid": F.when(is_p, amt.cast(MONEY)),
            "amount": F.when(is_c, amt),
            "_c_seq": F.when(is_c, seq),
            "_l_seq": F.when(et.isin(list(STATUS_OF)), seq),
            "_l_type": place,
            "_p_seq": F.when(is_p, seq),
            "_neg": is_p & (amt < 0)}


def _merge_aggs(p: dict[str, Column]) -> list[Column]:
    """Aggregates of the parts of events; they have the same form, so parts of more events can
    be added to them later, in any order."""
    return [
        F.coalesce(F.sum(p["_paid"]), F.lit(0).cast(MONEY)).alias("_paid"),
        F.max_by(p["amount"], p["_c_seq"]).alias("amount"),
        F.max(p["_c_seq"]).alias("_c_seq"),
        F.max(p["_l_seq"]).alias("_l_seq"),
        F.max_by(p["_l_type"], p["_l_seq"]).alias("_l_type"),
        F.max(p["_p_seq"]).alias("_p_seq"),
        F.max(p["_neg"]).alias("_neg"),
    ]


def _fold_aggs(id_col: str, seq_col: str) -> list[Column]:
    return _merge_aggs(_event_parts(seq_col))


def _status_from_aggs() -> Column:
    paid_after_l = F.col("_p_seq").isNotNull() & (
        F.col("_l_seq").isNull() | (F.col("_p_seq") > F.col("_l_seq")))
    enough = F.col("_paid") >= F.coalesce(
        F.when(F.col("_c_seq").isNotNull(), F.col("amount").cast(MONEY)), F.lit(0).cast(MONEY))
    return (F.when(paid_after_l & enough, "PAID")
            .when(F.col("_l_seq").isNotNull(), _status_of_place(F.col("_l_type")))
            .otherwise("UNKNOWN"))


def running_state(df: DataFrame, id_col: str = "aggregate_id",
                  seq_col: str = "seq") -> DataFrame:
    """Per event, the state after applying it (WN1, WN2): running paid, the
    amount known so far and the status.  Exact for any payment signs."""
    et, amt = F.col("event_type"), F.col("amount")
    w = (Window.partitionBy(id_col).orderBy(seq_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    paid = F.coalesce(F.sum(F.when(et == PAYMENT, amt.cast(MONEY))).over(w),
                      F.lit(0).cast(MONEY))
    known = F.last(F.when(et == CREATED, amt.cast(MONEY)), ignorenulls=True).over(w)
    step = df.withColumns({"_paid": paid, "_known": known})
    cand = (F.when(et == CREATED, "CREATED")
            .when((et == PAYMENT) & (F.col("_paid") >= F.coalesce(F.col("_known"),
                                                                  F.lit(0).cast(MONEY))), "PAID")
            .when(et == SHIPPED, "SHIPPED").when(et == CANCELLED, "CANCELLED"))
    return (step.withColumn("_cand", cand)
            .withColumn("status", F.coalesce(F.last("_cand", ignorenulls=True).over(w),
                                             F.lit("UNKNOWN")))
            .withColumn("paid", F.col("_paid").cast("double"))
            .drop("_cand", "_known", "_paid"))


def running_state_scan(df: DataFrame, id_col: str = "aggregate_id",
                       seq_col: str = "seq") -> DataFrame:
    """Per event the status candidate it sets, from running paid and the
    amount known so far computed by :func:`segmented_scan` (no window, so an
    aggregate holding most events is still split across tasks)."""
    et, amt = F.col("event_type"), F.col("amount")
    cents = lambda c: (c.cast(MONEY) * 100).cast("bigint")
    prep = df.withColumns({"_pay_c": F.when(et == PAYMENT, cents(amt)),
                           "_created_c": F.when(et == CREATED, cents(amt)).cast("double")})
    sc = segmented_scan(prep, id_col, [seq_col], {"_paid_c": "_pay_c"},
                        {"_known_c": "_created_c"})
    cand = (F.when(et == CREATED, "CREATED")
            .when((et == PAYMENT) & (F.col("_paid_c") >= F.coalesce(F.col("_known_c"),
                                                                    F.lit(0.0))), "PAID")
            .when(et == SHIPPED, "SHIPPED").when(et == CANCELLED, "CANCELLED"))
    return sc.withColumn("_cand", cand)


def fold_states(df: DataFrame, id_col: str = "aggregate_id", seq_col: str = "seq") -> DataFrame:
    """Current state of every aggregate that has events (AG5).

    Output: order_id, status, paid (DOUBLE), amount (null without a create).
    The main path is one partially aggregated pass.  Aggregates holding a
    negative payment are found by an event-level filter (``amount < 0``
    reaches the Parquet scan) and folded exactly with running sums.  Both
    branches are always planned; nothing runs before the action, and adaptive
    execution drops the exact branch when no such aggregate exists.
    """
    et, amt = F.col("event_type"), F.col("amount")
    aggs = df.groupBy(F.col(id_col).alias("order_id")).agg(*_fold_aggs(id_col, seq_col))
    simple = aggs.filter(~F.coalesce(F.col("_neg"), F.lit(False))).select(
        "order_id", _status_from_aggs().alias("status"),
        F.col("_paid").cast("double").alias("paid"), "amount")
    neg_ids = df.filter((et == PAYMENT) & (amt < 0)).select(id_col).distinct()
    hard = running_state(df.join(neg_ids, id_col, "left_semi"), id_col, seq_col)
    last = hard.groupBy(F.col(id_col).alias("order_id")).agg(
        F.max_by("status", F.col(seq_col)).alias("status"),
        F.coalesce(F.sum(F.when(F.col("event_type") == PAYMENT, F.col("amount").cast(MONEY))),
                   F.lit(0).cast(MONEY)).cast("double").alias("paid"),
        F.max_by(F.when(F.col("event_type") == CREATED, F.col("amount")),
                 F.when(F.col("event_type") == CREATED, F.col(seq_col))).alias("amount"))
    return simple.unionByName(last)


# ------------------------------------------------- fold of a growing log (AG5)
#: Statuses by number (from 1), as the replayed ones are kept in a fold.
STATUSES = ("UNKNOWN", "CREATED", "PAID", "SHIPPED", "CANCELLED")
#: Holds the sums of a fold; ``sum`` over MONEY gives the same type.
PAID_SUM = "decimal(28,2)"


def negative_payments(df: DataFrame) -> DataFrame:
    """Events whose aggregates :func:`fold_onto` needs a replay of."""
    return df.filter((F.col("event_type") == PAYMENT) & (F.col("amount") < 0))


def replayed_status(df: DataFrame, id_col: str = "aggregate_id", seq_col: str = "seq") -> DataFrame:
    """order_id, _replayed: number of the status that the whole history of an aggregate leads to,
    step by step.  ``df`` has all events of the aggregates in it."""
    names = F.array(*[F.lit(s) for s in STATUSES])
    return (running_state(df, id_col, seq_col).groupBy(F.col(id_col).alias("order_id"))
            .agg(F.max_by("status", F.col(seq_col)).alias("_s"))
            .select("order_id", F.array_position(names, F.col("_s")).cast("int").alias("_replayed")))


def fold_onto(old: DataFrame | None, df: DataFrame, replayed: DataFrame | None = None,
              id_col: str = "aggregate_id", seq_col: str = "seq") -> DataFrame:
    """:func:`fold_states` of the events in ``old`` (a result of this function) and ``df``
    together; the events in ``old`` are not read again.

    Output: order_id and what later events are added to; :func:`states_of` makes states of it.
    ``replayed`` gives the status of aggregates in ``df`` that have a negative payment in
    ``df`` or before; others keep the one they have."""
    parts = _event_parts(seq_col)
    rows = df.select(F.col(id_col).alias("order_id"), *[c.alias(n) for n, c in parts.items()],
                     F.lit(None).cast("int").alias("_exact"))
    if old is not None:
        rows = old.select(*rows.columns).unionByName(rows)
    out = rows.groupBy("order_id").agg(*_merge_aggs({n: F.col(n) for n in parts}),
                                       F.max("_exact").alias("_exact"))
    if replayed is not None:
        out = out.join(replayed, "order_id", "left").withColumn(
            "_exact", F.coalesce("_replayed", "_exact")).drop("_replayed")
    return out.withColumn("_paid", F.col("_paid").cast(PAID_SUM))


def states_of(folded: DataFrame) -> DataFrame:
    """order_id, status, paid, amount of a result of :func:`fold_onto`."""
    exact = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), F.col("_exact"))
    return folded.select(
        "order_id", F.when(F.coalesce(F.col("_neg"), F.lit(False)), exact)
        .otherwise(_status_from_aggs()).alias("status"),
        F.col("_paid").cast("double").alias("paid"), "amount")


def rebuild_state(df: DataFrame, aggregate_id, id_col: str = "aggregate_id",
                  seq_col: str = "seq") -> DataFrame:
    """State of one aggregate (AG4): order_id, status, paid, amount, customer,
    carrier, tracking, reason.  Always one row (UNKNOWN without events)."""
    ev = for_aggregate(df, aggregate_id, id_col)
    et, seq = F.col("event_type"), F.col(seq_col)

    def last_of(t: str, field: str) -> Column:
        return F.max_by(F.when(et == t, F.col(field)), F.when(et == t, seq)).alias(field)

    one = ev.agg(*_fold_aggs(id_col, seq_col), last_of(CREATED, "customer"),
                 last_of(SHIPPED, "carrier"), last_of(SHIPPED, "tracking"),
                 last_of(CANCELLED, "reason"))
    return one.select(
        F.lit(aggregate_id).cast(df.schema[id_col].dataType).alias("order_id"),
        _status_from_aggs().alias("status"), F.col("_paid").cast("double").alias("paid"),
        "amount", "customer", "carrier", "tracking", "reason")


def event_history(df: DataFrame, aggregate_id, id_col: str = "aggregate_id",
                  seq_col: str = "seq") -> DataFrame:
    """Log-ordered history of one aggregate with the running state (SO2)."""
    ev = for_aggregate(df, aggregate_id, id_col)
    return (running_state(ev, id_col, seq_col)
            .select(F.col(id_col).alias("order_id"), seq_col, "event_type", "amount",
                    "paid", "status")
            .orderBy(seq_col))


def whatif_diff(df: DataFrame, scenario: str, id_col: str = "aggregate_id",
                seq_col: str = "seq") -> DataFrame:
    """Hypothetical vs actual fold, driven by the hypothetical side (JN5).

    Output: order_id, status, paid, amount, actual_status, changed.
    """
    actual = fold_states(df, id_col, seq_col).select(
        "order_id", F.col("status").alias("actual_status"))
    hypo = fold_states(whatif(df, scenario), id_col, seq_col)
    return (hypo.join(actual, "order_id", "left")
            .withColumn("changed", ~F.col("status").eqNullSafe(F.col("actual_status"))))
