"""Tumbling-window aggregations (AG1, AG2, FN17, FN18, SO3, STR1).

Both operators group on a BIGINT window key ``floor(epoch / w) * w``.  The
aggregation is decomposable (counts and DECIMAL sums), so Spark runs a
partial aggregate before the shuffle: each task ships at most one row per
window it saw, and a hot window costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.numeric import money_sum, ratio_round
from logweave.functions.timecols import event_time, window_key

# The event types the KPI aggregator counts.
PAGE_VIEW = "page_view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tumbling_sales(df: DataFrame, window_s: int = 30, epoch_col: str = "event_epoch",
                   amount_col: str = "amount", fallback_epoch: Column | str | None = None,
                   ordered: bool = True) -> DataFrame:
    """Count and total amount per tumbling window (AG1).

    ``fallback_epoch`` is used when the payload has no event time (FN18).
    Output: window_start, window_end (BIGINT epoch s), count, total_amount (2 dp).
    A missing amount counts as 0 (``value.get("amount", 0)``).
    """
    t = event_time(epoch_col, fallback_epoch)
    out = (df.filter(t.isNotNull())
           .groupBy(window_key(t, window_s).alias("window_start"))
           .agg(F.count(F.lit(1)).alias("count"), money_sum(amount_col).alias("total_amount"))
           .select("window_start", (F.col("window_start") + window_s).alias("window_end"),
                   "count", "total_amount"))
    return out.orderBy("window_start") if ordered else out


def kpi_windows(df: DataFrame, window_s: int = 60, epoch_col: str = "event_epoch",
                type_col: str = "type", amount_col: str = "amount",
                fallback_epoch: Column | str | None = None, ordered: bool = True) -> DataFrame:
    """Per-window KPIs (AG2): page_views, add_to_carts, purchases, gmv (2 dp) and
    cvr = purchases / page_views (4 dp, 0.0 without views).

    Every event opens its window, so windows holding only other event types
    are reported with zero counts, as in the reference.
    """
    t = event_time(epoch_col, fallback_epoch)
    typ = _c(type_col)
    out = (df.filter(t.isNotNull())
           .groupBy(window_key(t, window_s).alias("window_start"))
           .agg(F.count_if(typ == PAGE_VIEW).alias("page_views"),
                F.count_if(typ == ADD_TO_CART).alias("add_to_carts"),
                F.count_if(typ == PURCHASE).alias("purchases"),
                money_sum(F.when(typ == PURCHASE, _c(amount_col))).alias("gmv"))
           .withColumn("cvr", ratio_round("purchases", "page_views", 4)))
    return out.orderBy("window_start") if ordered else out
