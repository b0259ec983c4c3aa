"""Exactly-once patterns on a log table (EO1-EO4, SRC8, SNK5, JN6).

* Atomic batches (EO1): a producer stages rows tagged with ``txn_id`` and
  writes one commit marker last; an aborted transaction has no marker.
* Read-committed (EO2/SRC8): staged rows semi-joined with commit markers.
  The marker table holds one row per transaction; it is not assumed small,
  so AQE picks broadcast only when its measured size is under the threshold.
* Idempotent processing (EO3): the first occurrence of an id in log order
  wins; later copies are duplicates.  ``min_by`` is partially aggregated, so
  a redelivery storm of one id is collapsed inside each task.
* Ledger (SNK5/JN6): ids already processed are removed with ``left_anti``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMMIT = "commit"


def read_committed(staged: DataFrame, markers: DataFrame, txn_col: str = "txn_id") -> DataFrame:
    """Rows of committed transactions only (EO2); where both tables name an
    ``attempt``, only the rows of the attempt that was committed."""
    on = [txn_col] + ["attempt"] * ("attempt" in staged.columns and "attempt" in markers.columns)
    committed = markers.filter(F.col("state") == COMMIT).select(*on)
    return staged.join(committed, on, "left_semi")


def commit_marker(spark, txn_id, attempt: str, state: str = COMMIT) -> DataFrame:
    """One marker row, written after the transaction's rows (EO1)."""
    return spark.createDataFrame([(txn_id, attempt, state)],
                                 "txn_id long, attempt string, state string")


def publish_atomic(rows: DataFrame, txn_id: int, staged_path: str, markers_path: str,
                   commit: bool = True) -> None:
    """Transactional publish on a log table (EO1): the rows are appended with
    their ``txn_id`` and an attempt id first and the commit marker, which names the
    attempt, last.  A failure in between leaves rows that :func:`read_committed`
    never shows, also after a retry under the same ``txn_id``; a transaction already
    committed is not published again.  ``commit=False`` is an explicit abort (no
    marker)."""
    spark, mine = rows.sparkSession, uuid.uuid4().hex
    try:
        done = spark.read.parquet(markers_path).filter(
            (F.col("txn_id") == txn_id) & (F.col("state") == COMMIT)).limit(1).count()
    except AnalysisException:       # no marker table yet
        done = 0
    if done:
        return
    rows.withColumns({"txn_id": F.lit(txn_id).cast("long"), "attempt": F.lit(mine)}) \
        .write.mode("append").parquet(staged_path)
    if commit:
        commit_marker(spark, txn_id, mine).write.mode("append").parquet(markers_path)


def first_occurrence(df: DataFrame, id_col: str, order_col: str = "off",
                     amount_col: str | None = "amount") -> DataFrame:
    """First row per id in log order (EO3); empty ids are skipped (FN19) and a
    missing amount reads as 0.  Output: id, amount (DOUBLE), off."""
    keep = df.filter(F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    amt = (F.coalesce(F.col(amount_col).cast("double"), F.lit(0.0)) if amount_col
           else F.lit(0.0))
    first = keep.groupBy(id_col).agg(
        F.min_by(F.struct(amt.alias("amount"), F.col(order_col).alias(order_col)),
                 F.col(order_col)).alias("_f"))
    return first.select(id_col, "_f.amount", f"_f.{order_col}")


def dedup_counters(df: DataFrame, id_col: str) -> DataFrame:
    """processed_unique, duplicates and ledger_total of one pass (AG6/AG11)."""
    keep = df.filter(F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    return keep.agg(F.count(F.lit(1)).alias("_n"),
                    F.count_distinct(id_col).alias("processed_unique")).select(
        "processed_unique", (F.col("_n") - F.col("processed_unique")).alias("duplicates"),
        F.col("processed_unique").alias("ledger_total"))


def not_in_ledger(batch: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id was never processed (JN6)."""
    return batch.join(ledger.select(id_col), id_col, "left_anti")


def in_ledger(batch: DataFrame, ledger: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id was already processed: the duplicates of a redelivery."""
    return batch.join(ledger.select(id_col), id_col, "left_semi")


def apply_once(batch: DataFrame, ledger: DataFrame, id_col: str, order_col: str = "off",
               amount_col: str | None = "amount") -> DataFrame:
    """New ledger entries for a batch: first occurrence per id, minus the ids
    already in the ledger (SNK5).  Appending the result keeps the ledger
    duplicate-free across restarts."""
    return not_in_ledger(first_occurrence(batch, id_col, order_col, amount_col), ledger, id_col)
