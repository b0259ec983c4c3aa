"""Evaluate an expensive expression once per row.

Catalyst pushes a filter below the projection that defines the column it
tests and substitutes the column's expression into the filter.  For cheap
expressions that is right; for JSON parsing it means every row is parsed
again inside the filter, and the inlined tree can outgrow whole-stage
codegen.  Columns produced by a generator cannot be substituted that way, so
``computed`` emits them from a one-element ``inline`` (one output row per
input row, compiled into the same whole-stage code).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """``df`` plus ``cols``, each evaluated exactly once per row."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))

