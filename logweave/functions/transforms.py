"""Row-level filters and enrichments (FN8, FN9, FN10, FN19, FN21)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's high-value threshold and tier bounds.
HIGH_VALUE_THRESHOLD = 10000.0
TIER_PLATINUM_ABOVE = 100000.0
TIER_GOLD_ABOVE = 50000.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tier(amount: Column | str) -> Column:
    """``>100000`` platinum, ``>50000`` gold, else silver (FN9)."""
    a = _c(amount)
    return (F.when(a > TIER_PLATINUM_ABOVE, "platinum")
            .when(a > TIER_GOLD_ABOVE, "gold").otherwise("silver"))


def high_value(df: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD,
               amount_col: str = "amount", stamp_col: str | None = "filtered_at") -> DataFrame:
    """Keep rows with ``amount > threshold`` (strict, FN8) and add ``tier``
    plus an optional processing-time stamp (FN10).  All input columns are
    kept; an existing ``tier`` column is overridden, as in a dict merge.
    A missing amount counts as 0 and so never passes a positive threshold."""
    amt = F.coalesce(_c(amount_col).cast("double"), F.lit(0.0))
    cols = {"tier": tier(amt)}
    if stamp_col:
        cols[stamp_col] = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    return df.filter(amt > F.lit(float(threshold))).withColumns(cols)


def non_empty_key(df: DataFrame, key_col: str) -> DataFrame:
    """Skip records whose key field is null or empty (FN19)."""
    k = _c(key_col)
    return df.filter(k.isNotNull() & (k.cast("string") != ""))


def tax_inclusive(df: DataFrame, rate: float, amount_col: str = "amount",
                  out_col: str = "amount_incl") -> DataFrame:
    """Tax-inclusive price (FN21): ``amount * (1 + rate)`` rounded half up to 2 dp, in exact
    arithmetic (amounts to six places, the rate as written).  The rate is required."""
    factor = F.lit(1 + Decimal(str(rate))).cast("decimal(12,8)")
    return df.withColumn(out_col, F.round(_c(amount_col).cast("decimal(22,6)") * factor, 2).cast("double"))
