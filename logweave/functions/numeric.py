"""Exact rounding helpers (FN20).

Money is summed as DECIMAL so totals do not depend on the order in which a
distributed aggregation adds rows; rates are rounded half-up from the exact
integer ratio.  Both give the same double in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: money is carried with two decimal places, as the reference
# rounds every published amount to 2 dp.
MONEY = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """A money column as DECIMAL with two places."""
    return _c(c).cast(MONEY)


def money_sum(c: Column | str, default_zero: bool = True) -> Column:
    """Order-independent sum of a money column, returned as DOUBLE."""
    s = F.sum(money(c))
    if default_zero:
        s = F.coalesce(s, F.lit(0).cast(MONEY))
    return s.cast("double")


def ratio_round(num: Column | str, den: Column | str, digits: int,
                zero_value: float = 0.0) -> Column:
    """``round(num / den, digits)`` half-up from exact integers; ``zero_value``
    when ``den`` is 0 (reference: ``(a / b) if b else 0.0``).  Inputs are
    non-negative integer counts."""
    n, d = _c(num).cast("decimal(38,0)"), _c(den).cast("decimal(38,0)")
    scale = 10 ** digits
    a = (n * F.lit(2 * scale)).cast("decimal(38,0)") + d
    b = (d * F.lit(2)).cast("decimal(38,0)")
    # Whole part of a / b, then the decimal point: exact in DECIMAL, of any size.
    k = ((a - a % b).cast("decimal(38,0)") / F.when(d != 0, b)).cast("decimal(38,0)")
    return F.when(d == 0, F.lit(float(zero_value))).otherwise(
        (k / F.lit(scale).cast("decimal(10,0)")).cast("double"))


def round_dp(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a DOUBLE through DECIMAL (no binary tie artefacts)."""
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")
