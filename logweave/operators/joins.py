"""Keyed stream joins (JN1-JN4).

* ``interval_join``: Spark's time-bounded equi-join, ``|t_l - t_r| <= bound``
  inclusive on both sides (JN1); the same expression drives the streaming
  join, where the watermark evicts state (JN3).  ``unmatched`` is its
  ``left_anti`` form (JN4).
* ``consume_on_match``: the reference's exact semantics (JN2).  Per key, in
  arrival order, each side keeps only its latest pending record; when both
  are pending and within the bound they are emitted and both are cleared, so
  a record joins at most once and the output never exceeds
  ``min(#left, #right)`` per key: no key can fan out into all its pairs.
  A small state machine streams through range partitions of the sorted
  rows (``mapInPandas``); a hot key is split over several partitions and
  stitched by chaining four-state transfer functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators.scan import pinned


def _band(lt: Column, rt: Column, bound_s: float) -> Column:
    return (rt >= lt - F.lit(bound_s)) & (rt <= lt + F.lit(bound_s))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str,
                  right_time: str, bound_s: float = 300, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` with ``|t_l - t_r| <= bound_s`` (JN1).

    The equality makes it a shuffle (or broadcast) equi-join with a residual
    band filter; no nested-loop join is involved."""
    lk, rk = F.col(f"_l.{key}"), F.col(f"_r.{key}")
    cond = (lk == rk) & _band(F.col(f"_l.{left_time}"), F.col(f"_r.{right_time}"), bound_s)
    return left.alias("_l").join(right.alias("_r"), cond, how)


def unmatched(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              bound_s: float = 300) -> DataFrame:
    """Left rows with no right row within the bound (JN4)."""
    return interval_join(left, right, key, left_time, right_time, bound_s, "left_anti")


def consume_on_match(left: DataFrame, right: DataFrame, key: str, left_time: str,
                     right_time: str, bound_s: float = 300,
                     left_order: Sequence[str] = (), right_order: Sequence[str] = (),
                     num_partitions: int | None = None) -> DataFrame:
    """1:1 consume-on-match join (JN2).

    Arrival order per key is ``(time, side, *order)`` with the left side first
    on equal times.  Output columns: ``matched`` (BOOLEAN), ``key``, then the
    left columns prefixed ``l_`` and the right columns prefixed ``r_``.
    Rows with ``matched = false`` are left records that never joined (they
    were superseded or no partner came within the bound; JN4).

    Records without a key (null or empty) or time are skipped.

    Keys with one record per side, nearly all of a usual log, are joined by one aggregate in
    the JVM.  For the others:

    Between two events of a key the join state is one of four values
    (pending left? pending right?); the pending records themselves are always
    the latest record of that side so far.  Rows are range-partitioned on
    ``(key, time, side, order)`` (a hot key spans several partitions) and
    pinned; three streaming passes then (1) summarise each partition's
    boundary key, (2) compute each partition's 4-state transfer function and
    (3) emit matches from the chained entry states.  The per-partition
    summaries (one small record per partition) are chained on the driver.  The
    Python passes see key, time, side and a row number only; the payloads are
    joined back by row number, so their values and types are untouched.
    """
    spark = left.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lsch, rsch = left.schema, right.schema
    n_ord = max(len(left_order), len(right_order))

    # Tie-break columns keep their native type (numeric order stays numeric);
    # the right side is cast to the left side's type at each position.
    ord_types = [(lsch[left_order[i]] if i < len(left_order) else rsch[right_order[i]]).dataType
                 for i in range(n_ord)]

    def side(df: DataFrame, s: int, t: str, order: Sequence[str]) -> DataFrame:
        own = F.struct(*[F.col(c) for c in df.columns])
        sel = [F.col(key).cast("string").alias("_key"), F.col(t).cast("double").alias("_t"),
               F.lit(s).alias("_side")]
        for i in range(n_ord):
            src = order[i] if i < len(order) else None
            sel.append((F.col(src) if src else F.lit(None)).cast(ord_types[i]).alias(f"_o{i}"))
        sel += [(own if s == 0 else F.lit(None).cast(lsch)).alias("_l"),
                (own if s == 1 else F.lit(None).cast(rsch)).alias("_r")]
        return df.select(*sel).filter((F.col("_key") != "") & F.col("_t").isNotNull())

    everything = side(left, 0, left_time, left_order).unionByName(
        side(right, 1, right_time, right_order))
    single, repeated = _single_records(everything, float(bound_s))
    both = everything.join(repeated, "_key", "left_semi")
    sort_cols = ["_key", "_t", "_side", *[f"_o{i}" for i in range(n_ord)]]
    rows = pinned(both.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
                  .withColumn("_row", F.monotonically_increasing_id()))
    # What the Python passes see; payloads never leave the JVM.
    events = rows.select("_key", "_t", "_side", "_row")
    bound = float(bound_s)

    # Pass 1: first/last key of every partition and, for the last key, its
    # latest left and right record inside the partition (-1: none).
    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, first, cur = False, None, None
        lo = lp = (0.0, -1)
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf["_key"].to_numpy(dtype=object)
            sd = pdf["_side"].to_numpy()
            if not seen:
                seen, first, cur = True, k[0], k[0]
            if k[-1] != cur:
                cur, lo, lp = k[-1], (0.0, -1), (0.0, -1)
            m = k == cur
            io = np.flatnonzero(m & (sd == 0))
            ip = np.flatnonzero(m & (sd == 1))
            if len(io):
                lo = (pdf["_t"].iat[io[-1]], pdf["_row"].iat[io[-1]])
            if len(ip):
                lp = (pdf["_t"].iat[ip[-1]], pdf["_row"].iat[ip[-1]])
        if seen:
            yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "first_key": [first],
                                "last_key": [cur], "lo_t": [lo[0]], "lo": [lo[1]],
                                "lp_t": [lp[0]], "lp": [lp[1]]})

    summ = {r.pid: r for r in events.mapInPandas(
        summarize, "pid int, first_key string, last_key string, lo_t double, lo long, "
                   "lp_t double, lp long").collect()}
    order_p = sorted(summ)
    carry: dict[int, tuple] = {}
    run_key, run_lo, run_lp = object(), None, None
    for p in order_p:
        s = summ[p]
        carry[p] = (run_lo, run_lp) if s.first_key == run_key else (None, None)
        lo = (s.lo_t, s.lo) if s.lo >= 0 else None
        lp = (s.lp_t, s.lp) if s.lp >= 0 else None
        if s.last_key == run_key:
            run_lo, run_lp = lo or run_lo, lp or run_lp
        else:
            run_key, run_lo, run_lp = s.last_key, lo, lp
    nxt = {p: summ[q].first_key for p, q in zip(order_p, order_p[1:])}

    # Pass 2: transfer function of the first run (all four entry states) and
    # the exit state of the last run started from "nothing pending".
    f_schema = "pid int, f0 int, f1 int, f2 int, f3 int, last_exit int"

    def transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Only the partition's first run and the trailing run of each batch
        # (a candidate for the partition's last run) are stepped; the keys
        # in between start and end inside the partition and need nothing.
        pid = TaskContext.get().partitionId()
        if pid not in summ:
            return
        s = summ[pid]
        c_lo, c_lp = carry[pid]
        f_lo = c_lo[0] if c_lo else None
        f_lp = c_lp[0] if c_lp else None
        states = [0, 1, 2, 3]
        in_first = True
        tail_key, tail_state, t_lo, t_lp = object(), 0, None, None
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf["_key"].to_numpy(dtype=object)
            ts = pdf["_t"].to_numpy()
            sd = pdf["_side"].to_numpy()
            nrow = len(k)
            lo_i = 0
            if in_first:
                diff = np.flatnonzero(k != s.first_key)
                end = int(diff[0]) if len(diff) else nrow
                for i in range(end):
                    states = [_step(x, sd[i], ts[i], f_lo, f_lp, bound) for x in states]
                    if sd[i] == 0:
                        f_lo = ts[i]
                    else:
                        f_lp = ts[i]
                if end == nrow:
                    continue
                in_first = False
                lo_i = end
            last = k[-1]
            start = lo_i + int(np.argmax(k[lo_i:] == last))
            if last != tail_key:
                tail_key, tail_state, t_lo, t_lp = last, 0, None, None
            for i in range(start, nrow):
                tail_state = _step(tail_state, sd[i], ts[i], t_lo, t_lp, bound)
                if sd[i] == 0:
                    t_lo = ts[i]
                else:
                    t_lp = ts[i]
        last_exit = states[0] if in_first else tail_state
        yield pd.DataFrame({"pid": [pid], "f0": [states[0]], "f1": [states[1]],
                            "f2": [states[2]], "f3": [states[3]], "last_exit": [last_exit]})

    fns = {r.pid: r for r in events.mapInPandas(transfer, f_schema).collect()}
    entry: dict[int, int] = {}
    run_key, state = object(), 0
    for p in order_p:
        s, f = summ[p], fns[p]
        e = state if s.first_key == run_key else 0
        entry[p] = e
        if s.first_key == s.last_key:
            state, run_key = (f.f0, f.f1, f.f2, f.f3)[e], s.first_key
        else:
            state, run_key = f.last_exit, s.last_key

    # Pass 3: run the join from the chained entry state and emit row numbers.
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        if pid not in summ:
            return
        c_lo, c_lp = carry[pid]
        cur = summ[pid].first_key
        pend_l = c_lo if (entry[pid] & 1) else None
        pend_r = c_lp if (entry[pid] & 2) else None
        for pdf in batches:
            out_l, out_r = [], []
            for k, t, sd, row in zip(pdf["_key"].tolist(), pdf["_t"].tolist(),
                                     pdf["_side"].tolist(), pdf["_row"].tolist()):
                if k != cur:
                    if pend_l is not None:
                        out_l.append(pend_l[1])
                        out_r.append(-1)
                    cur, pend_l, pend_r = k, None, None
                if sd == 0:
                    if pend_l is not None:      # superseded, never joined
                        out_l.append(pend_l[1])
                        out_r.append(-1)
                    pend_l = (t, row)
                else:
                    pend_r = (t, row)
                if pend_l is not None and pend_r is not None \
                        and abs(pend_l[0] - pend_r[0]) <= bound:
                    out_l.append(pend_l[1])
                    out_r.append(pend_r[1])
                    pend_l = pend_r = None
            if out_l:
                yield pd.DataFrame({"_lrow": out_l, "_rrow": out_r})
        if pend_l is not None and nxt.get(pid) != cur:
            yield pd.DataFrame({"_lrow": [pend_l[1]], "_rrow": [-1]})

    pairs = events.mapInPandas(run, "_lrow long, _rrow long")
    lrows = rows.filter("_side = 0").select(F.col("_row").alias("_lrow"), "_key", "_l")
    rrows = rows.filter("_side = 1").select(F.col("_row").alias("_rrow"), "_r")
    stepped = pairs.join(lrows, "_lrow").join(rrows, "_rrow", "left").select(
        (F.col("_rrow") >= 0).alias("matched"), "_key", "_l", "_r")
    return stepped.unionByName(single).select(
        "matched", F.col("_key").alias("key"),
        *[F.col("_l").getField(c).alias("l_" + c) for c in left.columns],
        *[F.col("_r").getField(c).alias("r_" + c) for c in right.columns])


def _single_records(both: DataFrame, bound: float) -> tuple[DataFrame, DataFrame]:
    """The join of the keys with at most one record per side (matched, _key, _l, _r), which
    one aggregate per key gives, and the other keys (_key), which need their order."""
    left, right = F.col("_side") == 0, F.col("_side") == 1
    counts = [F.count_if(left).alias("_nl"), F.count_if(right).alias("_nr")]
    keys = both.groupBy("_key").agg(
        *counts, F.max(F.when(left, F.col("_t"))).alias("_lt"), F.max(F.when(right, F.col("_t"))).alias("_rt"),
        F.first("_l", ignorenulls=True).alias("_l"), F.first("_r", ignorenulls=True).alias("_r"))
    met = F.coalesce(F.abs(F.col("_lt") - F.col("_rt")) <= bound, F.lit(False))
    single = keys.filter("_nl = 1 AND _nr <= 1").select(
        met.alias("matched"), "_key", "_l", F.when(met, F.col("_r")).alias("_r"))
    repeated = both.groupBy("_key").agg(*counts).filter("_nl > 1 OR _nr > 1").select("_key")
    return single, repeated


def _step(state: int, side: int, t: float, t_lo, t_lp, bound: float) -> int:
    """One event of the 4-state machine (bit 0: left pending, bit 1: right
    pending); the pending record is always the latest of its side."""
    if side == 0:
        if (state & 2) and t_lp is not None and abs(t - t_lp) <= bound:
            return 0
        return state | 1
    if (state & 1) and t_lo is not None and abs(t_lo - t) <= bound:
        return 0
    return state | 2

