"""Change data capture (CDC1-CDC3, AG11, SNK4).

Change envelopes have the shape ``{op, before, after, source, ts_ms}`` with
``before``/``after`` row structs.  ``c``/``u`` with a non-null ``after``
upsert ``after.id``; ``d`` with a non-null ``before`` deletes ``before.id``;
anything else is ignored.  The last change per key in log order wins.

Applying a log is one grouped ``max_by`` (partially aggregated before the
shuffle, so a hot key is reduced inside every task first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Debezium-style operation codes.
OP_CREATE, OP_UPDATE, OP_DELETE = "c", "u", "d"


def envelope(op: Column | str, before: Column, after: Column, table: str = "orders",
             ts_ms: Column | None = None) -> Column:
    """Build a change envelope struct (CDC2)."""
    ts = ts_ms if ts_ms is not None else F.unix_millis(F.current_timestamp())
    return F.struct(F.lit(op).alias("op") if isinstance(op, str) else op.alias("op"),
                    before.alias("before"), after.alias("after"),
                    F.struct(F.lit(table).alias("table"), ts.alias("ts_ms")).alias("source"),
                    ts.alias("ts_ms"))


def change_key(op: str = "op", before: str = "before", after: str = "after",
               key: str = "id") -> Column:
    """Row key a change applies to: ``before.id`` for deletes, else ``after.id``."""
    return F.when(F.col(op) == OP_DELETE, F.col(f"{before}.{key}")).otherwise(
        F.col(f"{after}.{key}"))


def applicable(df: DataFrame) -> DataFrame:
    """Keep the changes the replicator applies (valid op with its row image)."""
    op = F.col("op")
    ok = ((op.isin(OP_CREATE, OP_UPDATE) & F.col("after").isNotNull())
          | ((op == OP_DELETE) & F.col("before").isNotNull()))
    return df.filter(ok)


def apply_changes(df: DataFrame, order_col: str = "off", key: str = "id") -> DataFrame:
    """Replica after applying the whole change log (CDC1): one row per live
    key, columns of the ``after`` image."""
    last = (applicable(df)
            .groupBy(change_key(key=key).alias("_k"))
            .agg(F.max_by(F.struct("op", "after"), F.col(order_col)).alias("_last")))
    return last.filter(F.col("_last.op") != OP_DELETE).select("_last.after.*")


def latest_changes(df: DataFrame, order_col: str = "off", key: str = "id") -> DataFrame:
    """The last change of each key as a row of a versioned replica: ``_key``, ``_off`` (the
    change's offset), ``_deleted`` and ``_row`` (null for a deleted key)."""
    return (applicable(df).groupBy(change_key(key=key).alias("_key"))
            .agg(F.max_by(F.struct(F.col(order_col).alias("_off"),
                                   (F.col("op") == OP_DELETE).alias("_deleted"),
                                   F.when(F.col("op") != OP_DELETE, F.col("after")).alias("_row")),
                          F.col(order_col)).alias("_last"))
            .select("_key", "_last.*"))


def latest_rows(rows: DataFrame) -> DataFrame:
    """Per key of a versioned replica the row with the highest offset."""
    return (rows.groupBy("_key")
            .agg(F.max_by(F.struct("_off", "_deleted", "_row"), F.col("_off")).alias("_last"))
            .select("_key", "_last.*"))


def apply_incremental(replica: DataFrame, changes: DataFrame, order_col: str = "off",
                      key: str = "id") -> DataFrame:
    """New replica = untouched rows of ``replica`` + surviving upserts of the batch.  The
    changes must be later than the replica; :func:`merge_changes` takes them in any order."""
    touched = (applicable(changes).select(change_key(key=key).alias(key)).distinct())
    return (replica.join(touched, key, "left_anti")
            .unionByName(apply_changes(changes, order_col, key)))


def merge_changes(versions: DataFrame, changes: DataFrame, order_col: str = "off",
                  key: str = "id") -> DataFrame:
    """A versioned replica (see :func:`latest_changes`) after more changes, in any order: a
    change older than the row or tombstone it meets does nothing."""
    return latest_rows(versions.unionByName(latest_changes(changes, order_col, key)))


def replica_count(replica: DataFrame) -> DataFrame:
    """Row count of the replica (AG11)."""
    return replica.agg(F.count(F.lit(1)).alias("n"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "id",
                  table: str | None = "orders", ts_ms: Column | None = None) -> DataFrame:
    """Change events turning ``old`` into ``new`` (CDC2 re-aimed from the
    simulator): ``c`` for new keys, ``d`` for vanished keys, ``u`` when the
    row images differ; unchanged rows emit nothing.

    Output: op, before, after (row structs) [, source, ts_ms].
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    cols = [c for c in old.columns]
    o = old.select(F.col(key).alias("_k"), F.struct(*cols).alias("before"))
    n = new.select(F.col(key).alias("_k"), F.struct(*cols).alias("after"))
    j = o.join(n, "_k", "full_outer")
    op = (F.when(F.col("before").isNull(), OP_CREATE)
          .when(F.col("after").isNull(), OP_DELETE)
          .when(~F.col("before").eqNullSafe(F.col("after")), OP_UPDATE))
    out = j.select(op.alias("op"), "before", "after").filter(F.col("op").isNotNull())
    if table is not None:
        ts = ts_ms if ts_ms is not None else F.unix_millis(F.current_timestamp())
        out = out.withColumns({"source": F.struct(F.lit(table).alias("table"),
                                                  ts.alias("ts_ms")),
                               "ts_ms": ts})
    return out


def status_changes(df: DataFrame, from_status: str, to_status: str,
                   status_field: str = "status") -> DataFrame:
    """Updates moving a row from one status to another (CDC3)."""
    return df.filter((F.col("op") == OP_UPDATE)
                     & (F.col(f"before.{status_field}") == from_status)
                     & (F.col(f"after.{status_field}") == to_status))
