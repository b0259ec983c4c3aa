"""Structured Streaming forms of the batch operators (STR1-STR8).

* ``kpi_stream``: 1-minute KPI windows with a 2 s watermark in append mode
  (STR1, STR3): a window is emitted once the event-time watermark passes its
  end, and late rows are dropped (counted in ``numRowsDroppedByWatermark``);
  ``tag_late`` before it keeps them apart (STR4).
* ``rolling_stream``: sliding 60 s windows refreshed every second (STR2).
* ``join_stream``: stream-stream interval join; the band predicate plus
  watermarks bound the join state (JN3, STR5).
* ``tag_late``: rows that come after the watermark, tagged instead of dropped (STR4).
* ``dedup_stream``: read-committed transfers deduplicated against a ledger
  in ``foreachBatch`` (EO2, EO3, SNK5, EO4).
* ``dedup_keyed_stream``: the same with Spark's keyed state (no ledger scans).
* ``consume_stream``: consume-on-match join as a custom stateful operator over hash
  buckets of keys (``applyInPandasWithState``, event-time expiry).
* CDC replica and DLQ routing: ``foreachBatch`` sinks in
  :mod:`logweave.streaming.sinks`.

``run_available`` drives a query with ``availableNow`` into a Parquet table
and returns that table, so a stream can be checked against the batch result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.numeric import MONEY, ratio_round
from logweave.functions.timecols import to_event_timestamp
from logweave.operators import exactly_once as eo
from logweave.operators.windows import ADD_TO_CART, PAGE_VIEW, PURCHASE
from logweave.session import checkpoint_dir
from logweave.streaming import sinks


def kpi_stream(events: DataFrame, window_s: int = 60, grace: str = "2 seconds",
               epoch_col: str = "event_epoch") -> DataFrame:
    """Windowed KPIs of a streaming analytics log (append mode)."""
    ts = to_event_timestamp(epoch_col)
    typ = F.col("type")
    agg = (events.withColumn("_ts", ts).withWatermark("_ts", grace)
           .groupBy(F.window("_ts", f"{window_s} seconds").alias("w"))
           .agg(F.count_if(typ == PAGE_VIEW).alias("page_views"),
                F.count_if(typ == ADD_TO_CART).alias("add_to_carts"),
                F.count_if(typ == PURCHASE).alias("purchases"),
                F.sum(F.when(typ == PURCHASE, F.col("amount").cast(MONEY))).alias("_gmv")))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "page_views",
                      "add_to_carts", "purchases",
                      F.coalesce(F.col("_gmv"), F.lit(0).cast(MONEY)).cast("double").alias("gmv"),
                      ratio_round("purchases", "page_views", 4).alias("cvr"))


def rolling_stream(events: DataFrame, window_s: int = 60, slide_s: int = 1,
                   grace: str = "2 seconds", epoch_col: str = "event_epoch") -> DataFrame:
    """Sliding-window KPIs every ``slide_s`` seconds (STR2), in append mode.

    Events are first counted in buckets of one slide; a window sums its buckets.  So an
    event makes one state row, not one per window that holds it, and only buckets are
    spread over windows.  ``window_s`` is a multiple of ``slide_s``."""
    if window_s % slide_s:
        raise ValueError("the window must be a multiple of the slide")
    ts = to_event_timestamp(epoch_col)
    typ = F.col("type")
    buckets = (events.withColumn("_ts", ts).withWatermark("_ts", grace)
               .groupBy(F.window("_ts", f"{slide_s} seconds").alias("_b"))
               .agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(typ == PAGE_VIEW).alias("views"),
                    F.count_if(typ == PURCHASE).alias("bought"))
               .withColumn("_bt", F.window_time("_b")))
    return (buckets.groupBy(F.window("_bt", f"{window_s} seconds", f"{slide_s} seconds").alias("w"))
            .agg(F.sum("n").alias("window_count"), F.sum("views").alias("page_views"),
                 F.sum("bought").alias("purchases")))


def join_stream(orders: DataFrame, payments: DataFrame, key: str = "order_id",
                order_time: str = "order_epoch", payment_time: str = "payment_epoch",
                bound_s: int = 300, delay: str = "10 minutes", how: str = "inner") -> DataFrame:
    """Stream-stream join within ``bound_s`` seconds (JN1/JN3); ``leftOuter``
    emits unmatched orders once the watermark passes them (JN4).  No record is
    dropped: a key repeated inside the band joins each of its partners (for one
    partner per record use :func:`consume_stream`)."""
    o = (orders.withColumn("_ot", to_event_timestamp(order_time))
         .withWatermark("_ot", delay)).alias("o")
    p = (payments.withColumn("_pt", to_event_timestamp(payment_time))
         .withWatermark("_pt", delay)).alias("p")
    cond = (F.col(f"o.{key}") == F.col(f"p.{key}")) & \
        (F.col("p._pt") >= F.col("o._ot") - F.expr(f"INTERVAL {bound_s} SECONDS")) & \
        (F.col("p._pt") <= F.col("o._ot") + F.expr(f"INTERVAL {bound_s} SECONDS"))
    return o.join(p, cond, how)


def run_available(df: DataFrame, name: str, mode: str = "append", base: str | None = None,
                  out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over what is there now (``availableNow``) into
    Parquet and return the written table.  Called again with the same ``out`` and
    ``checkpoint`` it resumes from the committed offsets; by default both are fresh
    folders under the shared checkpoint folder."""
    spark = df.sparkSession
    out = out or sinks.scratch_path(base or checkpoint_dir(spark), f"{name}-out")
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", checkpoint or out + "-ckpt").option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def run_foreach(df: DataFrame, name: str, fn, base: str | None = None,
                checkpoint: str | None = None) -> None:
    """Run a streaming DataFrame over what is there now (``availableNow``) through a
    ``foreachBatch`` function.  With the same ``checkpoint`` it resumes from the
    committed offsets; the sink's markers are keyed by that folder."""
    spark = df.sparkSession
    where = checkpoint or sinks.scratch_path(base or checkpoint_dir(spark), f"{name}-ckpt")
    if hasattr(fn, "with_query"):
        fn = fn.with_query(where)
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", where)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_stream(spark: SparkSession, staged: DataFrame, markers: DataFrame, id_col: str,
                 ledger_path: str, marker_path: str, order_col: str = "off",
                 checkpoint: str | None = None) -> DataFrame:
    """Exactly-once consumer: read-committed (stream-static semi join with the
    commit markers), then first-occurrence dedup against the ledger."""
    committed = eo.read_committed(staged, markers)
    run_foreach(committed, "dedup", sinks.ledger_sink(ledger_path, marker_path, id_col,
                                                      order_col), checkpoint=checkpoint)
    return sinks.read_ledger(spark, ledger_path, marker_path)


def _json_row(df: DataFrame) -> Column:
    """All columns as one JSON text, times to the microsecond."""
    return F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def tag_late(events: DataFrame, epoch_col: str = "event_epoch", delay: str = "2 seconds",
             window_s: int | None = None, n_groups: int = 64) -> DataFrame:
    """Tag each row of a stream with ``late`` (STR4) instead of dropping late ones.

    The watermark is Spark's own, as the keyed state reports it: the highest event time of
    the batches before, less ``delay``.  With ``window_s`` a row is late if its window has
    ended by then and may have been emitted; without, if its time lies before the
    watermark.  A row without a time is never late, and nothing is late in the first batch.
    Rows keep their values; no state is stored.  It survives restarts with the checkpoint."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    schema = events.schema
    flat = [f.name for f in schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rows = events.select(
        F.pmod(F.xxhash64(*flat), F.lit(n_groups)).alias("_g"), _json_row(events).alias("_row"),
        to_event_timestamp(epoch_col).alias("_ts")).withWatermark("_ts", delay) \
        .withColumn("_ms", F.unix_millis("_ts"))

    def step(key, pdfs, state):
        import numpy as np
        import pandas as pd
        wm = state.getCurrentWatermarkMs()
        for pdf in pdfs:
            t = pdf["_ms"].to_numpy(dtype=float, na_value=np.nan)
            if window_s:
                late = (np.floor(t / (1000.0 * window_s)) + 1) * 1000 * window_s <= wm
            else:
                late = t < wm
            yield pd.DataFrame({"_row": pdf["_row"], "late": late & (wm > 0)})

    tagged = rows.groupBy("_g").applyInPandasWithState(
        step, "_row string, late boolean", "unused long", "append", GroupStateTimeout.NoTimeout)
    return tagged.select(F.from_json("_row", schema).alias("_v"), "late").select("_v.*", "late")


def consume_stream(orders: DataFrame, payments: DataFrame, key: str = "order_id",
                   order_time: str = "order_epoch", payment_time: str = "payment_epoch",
                   bound_s: int = 300, delay: str = "10 minutes",
                   n_buckets: int | None = None) -> DataFrame:
    """Streaming consume-on-match join (JN2-JN4) as a custom stateful operator.

    Keys are dealt over ``n_buckets`` hash buckets.  A bucket's state holds the latest pending
    order and payment of each of its keys, so a batch makes one Python call per bucket and not
    per key.  A key's new events are applied in arrival order (time, side).  The bucket's
    event-time timeout is its earliest expiry: ``bound_s`` after the newest pending record of a
    key the watermark drops the key (JN3) and its pending order is emitted as unmatched (JN4).
    Events older than the watermark are dropped, so ``delay`` bounds how late a partner may come.
    Output: matched, key, order_json, payment_json, order_t, payment_t, in append mode.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    n = n_buckets or 4 * int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [df.select(F.col(key).cast("string").alias("_key"), F.col(t).cast("double").alias("_t"),
                       F.lit(side).alias("_side"), F.to_json(F.struct(*df.columns)).alias("_payload"))
             for side, (df, t) in enumerate(((orders, order_time), (payments, payment_time)))]
    events = (sides[0].unionByName(sides[1]).withColumn("_ts", to_event_timestamp("_t"))
              .withWatermark("_ts", delay)
              .filter((F.col("_key") != "") & F.col("_t").isNotNull())
              .withColumn("_b", F.pmod(F.xxhash64("_key"), F.lit(n))))
    bound = float(bound_s)
    out_schema = ("matched boolean, key string, order_json string, payment_json string, "
                  "order_t double, payment_t double")

    def step(bucket, pdfs, state):
        import numpy as np
        import pandas as pd
        import pyarrow as pa
        cols = ["_key", "_t", "_side", "_payload"]
        parts = [] if state.hasTimedOut else [p[cols] for p in pdfs]
        n_old = 0
        if state.exists:
            parts.insert(0, pa.ipc.open_stream(state.get[0]).read_pandas())
            n_old = len(parts[0])
        rows = pd.concat(parts, ignore_index=True)
        key, t, side, pay = rows["_key"].to_numpy(object), rows["_t"].to_numpy(float), \
            rows["_side"].to_numpy(int), rows["_payload"].to_numpy(object)
        code, names = pd.factorize(key)
        # The pending order and payment of each key, as row numbers; -1 for none.
        held = np.full((len(names), 2), -1)
        held[code, side] = np.arange(len(rows))
        near = lambda a, b: abs(t[a] - t[b]) <= bound
        # A key with one record per side at most needs no order of arrival.
        busy = (np.bincount(2 * code + side, minlength=held.size).reshape(-1, 2) > 1).any(axis=1)
        pair = ~busy & (held >= 0).all(axis=1)
        pair[pair] = near(held[pair, 0], held[pair, 1])
        out_o, out_p = [held[pair, 0]], [held[pair, 1]]
        held[pair] = -1
        if busy.any():
            held[busy] = -1
            at = np.flatnonzero(busy[code])
            new = rows.iloc[at[at >= n_old]].sort_values(cols, kind="stable").index
            o, p = [], []
            for i in [*at[at < n_old].tolist(), *new.tolist()]:
                one, s = held[code[i]], side[i]
                if i >= n_old and s == 0 and one[0] >= 0:
                    o.append(one[0])
                    p.append(-1)
                one[s] = i
                if i >= n_old and one[0] >= 0 and one[1] >= 0 and near(one[0], one[1]):
                    o.append(one[0])
                    p.append(one[1])
                    one[:] = -1
            out_o.append(np.array(o, int))
            out_p.append(np.array(p, int))
        wm = state.getCurrentWatermarkMs()
        held = held[(held >= 0).any(axis=1)]
        last = np.where(held >= 0, t[held], -np.inf).max(axis=1)
        end = np.trunc((last + bound) * 1000).astype(np.int64) + 1
        gone = held[end <= wm, 0]
        out_o.append(gone[gone >= 0])
        out_p.append(np.full(len(out_o[-1]), -1))
        keep = held[end > wm].ravel()
        if len(keep):
            table = pa.Table.from_pandas(rows.iloc[np.sort(keep[keep >= 0])], preserve_index=False)
            buf = pa.BufferOutputStream()
            with pa.ipc.new_stream(buf, table.schema) as w:
                w.write_table(table)
            state.update((buf.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(int(end[end > wm].min()))
        elif state.exists:
            state.remove()
        o, p = np.concatenate(out_o), np.concatenate(out_p)
        if len(o):
            yield pd.DataFrame({
                "matched": p >= 0, "key": key[o], "order_json": pay[o],
                "payment_json": np.where(p >= 0, pay[p], None),
                "order_t": t[o], "payment_t": np.where(p >= 0, t[p], np.nan)})

    return events.groupBy("_b").applyInPandasWithState(
        step, out_schema, "pending binary", "append", GroupStateTimeout.EventTimeTimeout)


def dedup_keyed_stream(committed: DataFrame, id_col: str, event_time_col: str | None = None,
                       delay: str | None = None) -> DataFrame:
    """Idempotent consumption with Spark's keyed state instead of a ledger
    table (EO3 at scale): each id is emitted once, the first time a
    micro-batch brings it; later copies are dropped by the state store
    (RocksDB), so no batch rescans past ids.  With ``event_time_col`` and
    ``delay`` the state expires through the watermark
    (``dropDuplicatesWithinWatermark``).  Which copy wins inside one
    micro-batch is not defined; use the ledger sink when the first copy in
    log order must win."""
    keep = committed.filter(F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    if event_time_col and delay:
        return (keep.withColumn("_ts", to_event_timestamp(event_time_col))
                .withWatermark("_ts", delay).dropDuplicatesWithinWatermark([id_col])
                .drop("_ts"))
    return keep.dropDuplicates([id_col])
