"""Global ordered prefix sums without a single-partition window.

Spark's ``Window.orderBy(...)`` without ``partitionBy`` moves every row into
one task.  ``prefix_sums`` computes the same running totals in parallel:

1. range-partition the rows on the ordering key (sampled boundaries, so a
   dense key range is split over many tasks by row count) and sort inside
   each partition;
2. per partition, running sums in numpy (``mapInPandas``), emitted only for
   the rows the caller asks for;
3. per-partition totals with a JVM aggregate, turned into partition offsets
   by an exclusive running sum over at most ``n`` rows, broadcast back (the
   offsets table has exactly one row per partition: a proven size bound).

Spark seeds the range partitioner's sample with the RDD id, so two
evaluations of the same range shuffle may cut different boundaries.  The
partitioned rows are therefore pinned once with a reliable ``checkpoint()``
(to the cluster's ``spark.checkpoint.dir``) and both consumers read that
copy; it also survives the loss of executors.  Weights are integers, so sums
are exact and independent of the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logweave.session import checkpoint_dir


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    conf = df.sparkSession.conf
    return max(int(conf.get("spark.sql.shuffle.partitions")), 1)


def pinned(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with its partitioning to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def prefix_sums(points: DataFrame, order_cols: Sequence[str], weight_cols: Sequence[str],
                emit_col: str, keep_cols: Sequence[str],
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``weight_cols`` (BIGINT) in the total order
    ``order_cols``, returned for rows where ``emit_col`` is true.

    Output: ``keep_cols`` + one column per weight (same names).
    ``order_cols`` must be a total order (add a unique tie-breaker).
    """
    n = _num_partitions(points, num_partitions)
    cols = list(dict.fromkeys([*order_cols, *keep_cols, *weight_cols, emit_col]))
    base = points.select(*[F.col(c) for c in cols]).withColumns(
        {w: F.coalesce(F.col(w).cast("bigint"), F.lit(0).cast("bigint")) for w in weight_cols})
    rp = pinned(base.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols))

    out_fields = [T.StructField("_pid", T.IntegerType(), False)]
    out_fields += [base.schema[c] for c in keep_cols]
    out_fields += [T.StructField(w, T.LongType(), False) for w in weight_cols]
    out_schema = T.StructType(out_fields)
    wcols = list(weight_cols)
    kcols = list(keep_cols)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        carry = np.zeros(len(wcols), dtype=np.int64)
        for pdf in batches:
            if pdf.empty:
                continue
            run = pdf[wcols].to_numpy(dtype=np.int64).cumsum(axis=0) + carry
            carry = run[-1].copy()
            mask = pdf[emit_col].to_numpy(dtype=bool)
            if not mask.any():
                continue
            res = pdf.loc[mask, kcols].reset_index(drop=True)
            res.insert(0, "_pid", np.int32(pid))
            sel = run[mask]
            for i, w in enumerate(wcols):
                res[w] = sel[:, i]
            yield res

    loc = rp.mapInPandas(local, out_schema)
    totals = rp.groupBy(F.spark_partition_id().alias("_pid")).agg(
        *[F.sum(w).alias(f"_t_{w}") for w in wcols])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_t_{w}").over(before), F.lit(0)).alias(f"_o_{w}")
                  for w in wcols])
    return (loc.join(F.broadcast(offsets), "_pid")
            .select(*kcols, *[(F.col(w) + F.col(f"_o_{w}")).alias(w) for w in wcols]))


def global_positions(df: DataFrame, order_cols: Sequence[str],
                     num_partitions: int | None = None) -> DataFrame:
    """Attach ``_pos``: the 1-based position of each row in the total order
    ``order_cols``, computed JVM-side (range shuffle + per-partition row
    counter + broadcast partition offsets)."""
    n = _num_partitions(df, num_partitions)
    rp = pinned(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols))
    mid = rp.withColumn("_mid", F.monotonically_increasing_id())
    with_local = mid.select("*", F.shiftright("_mid", 33).cast("int").alias("_pid"),
                            (F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_local"))
    totals = rp.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    return (with_local.join(F.broadcast(offsets), "_pid")
            .withColumn("_pos", F.col("_local") + F.col("_o"))
            .drop("_mid", "_pid", "_local", "_o"))


def segmented_scan(df: DataFrame, key: str, order_cols: Sequence[str],
                   sums: dict[str, str], lasts: dict[str, str],
                   num_partitions: int | None = None) -> DataFrame:
    """Per ``key`` in ``order_cols`` order: inclusive running sums (``sums``:
    output name -> BIGINT column) and the last non-null value so far
    (``lasts``: output name -> DOUBLE column).  Returns ``df`` with the new
    columns.

    Unlike ``Window.partitionBy(key)``, a key holding most of the rows is
    not confined to one task: rows are range-partitioned on
    ``(key, *order_cols)``, each partition is scanned in numpy, and a key
    that spans partitions is stitched from one summary record per partition
    (carried forward on the driver, bounded by the partition count).
    ``order_cols`` must make the order total within a key.
    """
    n = _num_partitions(df, num_partitions)
    sort_cols = [key, *order_cols]
    base = df.withColumns({**{f"_sw_{k}": F.coalesce(F.col(c).cast("bigint"),
                                                      F.lit(0).cast("bigint"))
                              for k, c in sums.items()},
                           **{f"_lw_{k}": F.col(c).cast("double") for k, c in lasts.items()}})
    rows = pinned(base.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols))
    snames, lnames = list(sums), list(lasts)

    summ_schema = T.StructType(
        [T.StructField("pid", T.IntegerType()), T.StructField("first_key", T.StringType()),
         T.StructField("last_key", T.StringType())]
        + [T.StructField(f"s_{k}", T.LongType()) for k in snames]
        + [T.StructField(f"l_{k}", T.DoubleType()) for k in lnames])

    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = cur = None
        tot = np.zeros(len(snames), dtype=np.int64)
        last = [np.nan] * len(lnames)
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf[key].astype(str).to_numpy(dtype=object)
            if first is None:
                first = k[0]
            if k[-1] != cur:
                cur = k[-1]
                tot = np.zeros(len(snames), dtype=np.int64)
                last = [np.nan] * len(lnames)
            m = k == cur
            for j, s in enumerate(snames):
                tot[j] += int(pdf[f"_sw_{s}"].to_numpy(dtype=np.int64)[m].sum())
            for j, s in enumerate(lnames):
                v = pdf[f"_lw_{s}"].to_numpy(dtype=float)[m]
                v = v[~np.isnan(v)]
                if len(v):
                    last[j] = v[-1]
        if first is None:
            return
        rec = {"pid": [TaskContext.get().partitionId()], "first_key": [first],
               "last_key": [cur]}
        rec.update({f"s_{s}": [int(tot[j])] for j, s in enumerate(snames)})
        rec.update({f"l_{s}": [None if np.isnan(last[j]) else float(last[j])]
                    for j, s in enumerate(lnames)})
        yield pd.DataFrame(rec)

    summ = {r.pid: r for r in rows.mapInPandas(summarize, summ_schema).collect()}
    carry: dict[int, tuple] = {}
    run_key, run_s, run_l = object(), [0] * len(snames), [None] * len(lnames)
    for p in sorted(summ):
        r = summ[p]
        carry[p] = ((list(run_s), list(run_l)) if r.first_key == run_key
                    else ([0] * len(snames), [None] * len(lnames)))
        ps = [r[f"s_{s}"] for s in snames]
        pl = [r[f"l_{s}"] for s in lnames]
        if r.last_key == run_key:
            run_s = [a + b for a, b in zip(run_s, ps)]
            run_l = [b if b is not None else a for a, b in zip(run_l, pl)]
        else:
            run_key, run_s, run_l = r.last_key, ps, pl

    out_schema = T.StructType(
        [f for f in df.schema.fields]
        + [T.StructField(k, T.LongType(), True) for k in snames]
        + [T.StructField(k, T.DoubleType(), True) for k in lnames])
    keep = list(df.columns)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        if pid not in summ:
            return
        cur = summ[pid].first_key
        c_s, c_l = carry[pid]
        c_s = np.array(c_s, dtype=np.int64)
        c_l = [np.nan if v is None else v for v in c_l]
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf[key].astype(str).to_numpy(dtype=object)
            # Segment ids: a new segment at every key change; segment 0
            # continues the carried key.
            change = np.empty(len(k), dtype=bool)
            change[0] = k[0] != cur
            change[1:] = k[1:] != k[:-1]
            seg = np.cumsum(change)
            first_is_carry = not change[0]
            out = pdf[keep].copy()
            for j, s in enumerate(snames):
                w = pdf[f"_sw_{s}"].to_numpy(dtype=np.int64)
                cs = np.cumsum(w)
                starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
                before = np.r_[0, cs][starts]          # cumsum before each segment
                seg_idx = np.searchsorted(starts, np.arange(len(k)), side="right") - 1
                val = cs - before[seg_idx]
                if first_is_carry:
                    val[seg == seg[0]] += c_s[j]
                out[s] = val
            for j, s in enumerate(lnames):
                v = pd.Series(pdf[f"_lw_{s}"].to_numpy(dtype=float))
                filled = v.groupby(seg).ffill()
                if first_is_carry and not np.isnan(c_l[j]):
                    mask = (seg == seg[0]) & filled.isna().to_numpy()
                    filled[mask] = c_l[j]
                out[s] = filled.to_numpy()
            # Carry into the next batch of this partition.
            last_seg = seg == seg[-1]
            tail_key = k[-1]
            new_s = np.array([out[s].to_numpy()[-1] for s in snames], dtype=np.int64)
            new_l = []
            for s in lnames:
                vals = out[s].to_numpy(dtype=float)[last_seg]
                new_l.append(vals[-1] if len(vals) else np.nan)
            cur, c_s, c_l = tail_key, new_s, new_l
            yield out

    return rows.mapInPandas(emit, out_schema)
