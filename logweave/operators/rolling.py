"""Rolling-window KPIs (AG3, WN3, SO1, STR2).

* ``rolling_snapshot``: KPIs over ``[asof - w, +inf)`` plus the lifetime
  total, in one pass; ``asof`` defaults to ``max(event time)`` computed by a
  scalar subquery, so no row ever leaves the executors.
* ``rolling_series``: the same KPIs as of every event, over the frame
  ``[t - w, t]``, as differences of global running sums (see
  :mod:`logweave.operators.scan`): no task ever holds a whole window, so a
  burst of events in one second is split across tasks like any other span.
* ``top_products``: top-k products by purchases in the window, ties broken
  by first occurrence, then product name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.functions.numeric import money_sum
from logweave.operators.scan import prefix_sums
from logweave.operators.windows import ADD_TO_CART, PAGE_VIEW, PURCHASE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolve_asof(df: DataFrame, epoch_col: str, asof: float | Column | None) -> Column:
    """``asof`` as a Column; by default ``max(epoch_col)`` as a scalar subquery."""
    if asof is None:
        return df.select(F.max(epoch_col)).scalar()
    return asof if isinstance(asof, Column) else F.lit(float(asof))


def rolling_snapshot(df: DataFrame, window_s: int = 60, asof: float | Column | None = None,
                     epoch_col: str = "event_epoch", type_col: str = "type",
                     amount_col: str = "amount") -> DataFrame:
    """One row: page_views, add_to_carts, purchases, gmv, cvr, eps,
    window_count (events with ``epoch >= asof - w``) and total (all events)."""
    asof_c = resolve_asof(df, epoch_col, asof)
    # The in-window flag is computed once, so the scalar subquery for
    # ``asof`` appears once in the plan.
    flagged = df.withColumn("_inw", _c(epoch_col) >= asof_c - F.lit(float(window_s)))
    inw = F.col("_inw")
    typ = _c(type_col)
    snap = flagged.agg(
        F.count_if(inw & (typ == PAGE_VIEW)).alias("page_views"),
        F.count_if(inw & (typ == ADD_TO_CART)).alias("add_to_carts"),
        F.count_if(inw & (typ == PURCHASE)).alias("purchases"),
        money_sum(F.when(inw & (typ == PURCHASE), _c(amount_col))).alias("gmv"),
        F.count_if(inw).alias("window_count"),
        F.count(F.lit(1)).alias("total"))
    return snap.select(
        "page_views", "add_to_carts", "purchases", "gmv",
        F.when(F.col("page_views") > 0, F.col("purchases") / F.col("page_views"))
        .otherwise(F.lit(0.0)).alias("cvr"),
        (F.col("window_count") / F.lit(float(window_s))).alias("eps"),
        "window_count", "total")


def top_products(df: DataFrame, k: int = 5, window_s: int | None = 60,
                 asof: float | Column | None = None, epoch_col: str = "event_epoch",
                 type_col: str = "type", product_col: str = "product",
                 order_cols: tuple[str, ...] = ("event_epoch", "event_id")) -> DataFrame:
    """Top-``k`` products by purchase count (SO1).  ``window_s=None`` ranks the
    whole log.  Output: rank, product, purchases."""
    p = df.filter(_c(type_col) == PURCHASE)
    if window_s is not None:
        p = p.filter(_c(epoch_col) >= resolve_asof(df, epoch_col, asof) - F.lit(float(window_s)))
    first = F.min(F.struct(*[F.col(c) for c in order_cols]))
    counted = (p.groupBy(_c(product_col).alias("product"))
               .agg(F.count(F.lit(1)).alias("purchases"), first.alias("_first")))
    order = [F.col("purchases").desc(), F.col("_first").asc(), F.col("product").asc()]
    top = counted.orderBy(*order).limit(k)
    # Ranking a k-row result: a single-partition window is bounded by k.
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
                      "product", "purchases")


def rolling_series(df: DataFrame, window_s: int = 60, epoch_col: str = "event_epoch",
                   type_col: str = "type", amount_col: str = "amount",
                   id_col: str = "event_id", num_partitions: int | None = None) -> DataFrame:
    """KPIs as of every event over the frame ``[t - w, t]`` (WN3).

    Every KPI is a sum, so the frame value is ``S(<= t) - S(< t - w)`` where
    ``S`` is a global running sum in event-time order.  Events of one time have one
    frame, so they are added up per distinct time first (map-side); each time gives two
    points, itself and ``t - w``, and :func:`prefix_sums` evaluates all in parallel.  The
    events take their frame by an equi-join on the time.

    Output: event_id, event_epoch, page_views, add_to_carts, purchases, gmv,
    window_count; events without a time give no row.
    """
    w = float(window_s)
    typ = F.col("_type")
    ev = df.select(_c(id_col).alias("event_id"), _c(epoch_col).cast("double").alias("_t"),
                   _c(type_col).alias("_type"), _c(amount_col).alias("_amount")) \
        .filter(F.col("_t").isNotNull())
    weights = {
        "page_views": F.count_if(typ == PAGE_VIEW),
        "add_to_carts": F.count_if(typ == ADD_TO_CART),
        "purchases": F.count_if(typ == PURCHASE),
        "gmv_cents": F.coalesce(F.sum(F.when(typ == PURCHASE, (F.col("_amount").cast("decimal(18,2)") * 100)
                                             .cast("bigint"))), F.lit(0).cast("bigint")),
        "window_count": F.count(F.lit(1)),
    }
    per = ev.groupBy("_t").agg(*[c.alias(n) for n, c in weights.items()])

    def point(k: Column, tag: int) -> Column:
        return F.struct(k.alias("_k"), F.lit(tag).alias("_tag"), F.col("_t"), F.lit(True).alias("_emit"),
                        *[(F.col(n) if tag else F.lit(0).cast("bigint")).alias(n) for n in weights])

    pts = per.select(F.inline(F.array(point(F.col("_t"), 1), point(F.col("_t") - F.lit(w), 0))))
    sums = prefix_sums(pts, ["_k", "_tag", "_t"], list(weights), "_emit", ["_t", "_tag"], num_partitions)
    sign = F.when(F.col("_tag") == 1, 1).otherwise(-1)
    framed = sums.groupBy("_t").agg(*[F.sum(F.col(n) * sign).alias(n) for n in weights])
    return ev.select("event_id", "_t").join(framed, "_t").select(
        "event_id", F.col("_t").alias("event_epoch"), "page_views", "add_to_carts", "purchases",
        (F.col("gmv_cents") / F.lit(100.0)).alias("gmv"), "window_count")
