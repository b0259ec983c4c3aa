"""``foreachBatch`` sinks with exactly-once effects (SNK4, SNK5, DLQ1-DLQ4, ST2, EO4, STR4,
STR7, AG6).

Spark may replay a micro-batch after a failure, and a query may be started again while its old
driver still runs.  Every sink here writes its data into folders of the attempt and then puts
one entry into a :mod:`commit log <logweave.streaming.commits>`: all its tables, counters and
offsets show together or not at all, a replayed batch is skipped, and an older driver is fenced.

The cost of a batch follows the batch: the replica, the fold and the ledger rewrite or read
only the hash buckets that the batch touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logweave.operators import cdc, dlq
from logweave.operators import eventsourcing as es
from logweave.operators import exactly_once as eo
from logweave.sources import logtable
from logweave.streaming.commits import CommitLog, Table, exactly_once, joined

N_BUCKETS = 16


def scratch_path(base: str, name: str) -> str:
    """A fresh, unique sub-path of ``base`` (never reused between runs)."""
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, name: str, path: str, commits_path: str) -> DataFrame | None:
    """Committed rows of a sink's table; None before the first commit."""
    return Table(CommitLog(spark, commits_path), name, path).read()


def counters(spark: SparkSession, commits_path: str) -> DataFrame:
    """counter, value: the totals of all committed batches (AG6, UDF3)."""
    c = CommitLog(spark, commits_path).state()["counters"]
    return spark.createDataFrame(sorted(c.items()), "counter string, value long")


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows that are counted while they are written."""
    o = Observation()
    return rows.observe(o, F.count(F.lit(1)).alias("n")), o


def _seen(o: Observation) -> int:
    """The count of an observation; Spark drops it from a plan that it finds to be empty."""
    try:
        return o.get.get("n", 0)
    except Py4JJavaError:
        return 0


# ----------------------------------------------------- CDC replica (SNK4, CDC1)
def _replica(log: CommitLog, path: str, n_buckets: int) -> Table:
    return Table(log, "replica", path, "_key", n_buckets)


def read_replica(spark: SparkSession, table_path: str, commits_path: str) -> DataFrame | None:
    """The live rows as of the last commit, or None before the first."""
    rows = _replica(CommitLog(spark, commits_path), table_path, 1).read()
    return None if rows is None else rows.filter(~F.col("_deleted")).select("_row.*")


def cdc_replica_sink(table_path: str, commits_path: str, order_col: str = "off", key: str = "id",
                     n_buckets: int = N_BUCKETS, query: str = "cdc"):
    """Upsert store fed by change events (SNK4).

    A row carries the offset of its last change, and a deleted key stays as a tombstone, so
    batches may come again or out of order: per key the change with the highest offset wins.
    Only the buckets with a changed key are read and rewritten."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        t = _replica(log, table_path, n_buckets)
        changes = cdc.latest_changes(batch, order_col, key).persist()
        try:
            buckets = t.touched(changes)
            if not buckets:
                return {}
            old = t.read(state, buckets)
            rows = changes if old is None else cdc.latest_rows(old.unionByName(changes))
            return t.replace(rows)
        finally:
            changes.unpersist()
    return exactly_once(commits_path, query, body)


# --------------------------------------------------- incremental fold (AG4, AG5)
def fold_sink(events_path: str, states_path: str, commits_path: str, key: str = "aggregate_id",
              state_key: str = "order_id", n_buckets: int = N_BUCKETS, query: str = "fold"):
    """Keep the folded state of every aggregate up to date (AG4, AG5 on a stream).

    A batch is added to a log in hash buckets by aggregate, and its events are folded onto the
    buckets of the state table that it touches; their rows hold what later events are added
    to, and :func:`read_states` makes states of them.  The log is not read again, but for
    aggregates with a negative payment: these are replayed from their buckets of the log when
    events of theirs come.  Events may come in any order: the fold goes by their sequence.
    Events without an aggregate stay in the log and have no state."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        events = Table(log, "events", events_path, key, n_buckets)
        states = Table(log, "states", states_path, state_key, n_buckets)
        new, schema = events.write(batch)
        if not new:
            return {}
        seen = {**state, "schemas": {**state["schemas"], **schema}}
        fresh = events.read(seen, folders=[f for fs in new.values() for f, _ in fs]) \
            .filter(F.col(key).isNotNull())
        old = states.read(state, new)
        hard = es.negative_payments(fresh).select(key)
        if old is not None:
            hard = hard.unionByName(old.filter("_neg").select(F.col(state_key).alias(key)))
        buckets = events.touched(hard)
        if buckets:
            hard = hard.join(fresh.select(key), key, "left_semi").distinct()
            buckets = events.touched(hard)
        replayed = None
        if buckets:
            history = events.read(seen, folders=events.folders(state, buckets)
                                  + [f for b in buckets for f, _ in new[b]])
            replayed = es.replayed_status(history.join(hard, key, "left_semi"), key)
        folded = es.fold_onto(old, fresh, replayed, key)
        return joined({"schemas": schema}, events.appended(seen, new), states.replace(folded))
    return exactly_once(commits_path, query, body)


def read_states(spark: SparkSession, states_path: str, commits_path: str) -> DataFrame | None:
    rows = read_table(spark, "states", states_path, commits_path)
    return None if rows is None else es.states_of(rows)


# ------------------------------------------------------------ ledger (SNK5, EO3)
#: Filter bits per id and bits set per id: about one id in 15,000 is looked up for nothing.
BITS_PER_ID, PROBES = 24, 8


def _hashes(id_col: str) -> list[Column]:
    text = F.col(id_col).cast("string")
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _bits(h1: np.ndarray, h2: np.ndarray, n: int) -> np.ndarray:
    """PROBES bit numbers below ``n`` (a power of two) for each id, a row per probe."""
    a, b = h1.astype(np.int64).view(np.uint64), h2.astype(np.int64).view(np.uint64) | np.uint64(1)
    k = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((a + k * b) & np.uint64(n - 1)).astype(np.int64)


def _filter_path(folder: str) -> str:
    return folder.replace("/_bucket=", ".filter/_bucket=")


def _index(id_col: str):
    """Writes a Bloom filter of the ids of each bucket beside an attempt's folder."""
    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        n = 64
        while n < BITS_PER_ID * len(pdf):
            n *= 2
        on = np.zeros(n, np.uint8)
        on[_bits(pdf["h1"].to_numpy(), pdf["h2"].to_numpy(), n).ravel()] = 1
        return pd.DataFrame({"_bucket": pdf["_bucket"].iloc[:1], "bits": [np.packbits(on).tobytes()]})

    def build(t: Table, attempt: str) -> None:
        spark = t.log.spark
        (spark.read.parquet(f"{t.path}/{attempt}").select("_bucket", *_hashes(id_col))
         .groupBy("_bucket").applyInPandas(make, "_bucket int, bits binary")
         .write.partitionBy("_bucket").parquet(f"{t.path}/{attempt}.filter"))
    return build


def _ledger(log: CommitLog, path: str, id_col: str, n_buckets: int) -> Table:
    return Table(log, "ledger", path, id_col, n_buckets, _index(id_col))


def may_hold(t: Table, state: dict, ids: DataFrame, id_col: str) -> list[str]:
    """Folders of the ledger whose filter lets at least one of the ids through.  Only the
    filters of buckets that the ids fall into are read; the result names folders, of which
    a bucket has a few."""
    folders = t.folders(state, t.touched(ids))
    if not folders:
        return []
    spark = ids.sparkSession
    filters = (spark.read.schema("bits binary").parquet(*[f"{t.path}/{_filter_path(f)}" for f in folders])
               .select("bits", F.regexp_extract(F.input_file_name(), r"([^/]+)\.filter/(_bucket=(\d+))/", 1)
                       .alias("attempt"),
                       F.regexp_extract(F.input_file_name(), r"_bucket=(\d+)/", 1).cast("int").alias("_b")))

    def probe(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        hit = []
        for attempt, bits in zip(theirs["attempt"], theirs["bits"]):
            on = np.unpackbits(np.frombuffer(bits, np.uint8))
            places = _bits(mine["h1"].to_numpy(), mine["h2"].to_numpy(), len(on))
            if len(mine) and on[places].all(axis=0).any():
                hit.append(f"{attempt}/_bucket={theirs['_b'].iloc[0]}")
        return pd.DataFrame({"folder": pd.Series(hit, dtype=object)})

    mine = ids.select(t.bucket().alias("_b"), *_hashes(id_col))
    found = mine.groupBy("_b").cogroup(filters.groupBy("_b")).applyInPandas(probe, "folder string")
    return sorted(r.folder for r in found.collect())


def ledger_sink(ledger_path: str, commits_path: str, id_col: str, order_col: str = "off",
                amount_col: str | None = "amount", n_buckets: int = N_BUCKETS, query: str = "ledger"):
    """Add the first occurrences of ids never seen before to the ledger (SNK5, EO3).

    The ledger lies in hash buckets, each folder with a Bloom filter of its ids.  A batch reads
    the filters of its buckets, and of the ledger only folders that may hold one of its
    ids; ids that are all new read none.  Counters: ``ledger_new``, ``ledger_folders_read``."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        t = _ledger(log, ledger_path, id_col, n_buckets)
        first = eo.first_occurrence(batch, id_col, order_col, amount_col).persist()
        try:
            folders = may_hold(t, state, first, id_col)
            new = first
            if folders:
                new = eo.not_in_ledger(first, t.read(state, folders=folders), id_col)
            new, seen = _observed(new)
            change = t.append(state, new)
            return change | {"counters": {"ledger_new": _seen(seen),
                                          "ledger_folders_read": len(folders)}}
        finally:
            first.unpersist()
    return exactly_once(commits_path, query, body)


def read_ledger(spark: SparkSession, ledger_path: str, commits_path: str) -> DataFrame | None:
    return read_table(spark, "ledger", ledger_path, commits_path)


# ---------------------------------------------------------- DLQ router (DLQ1, DLQ2)
def dlq_router(main_path: str, dlq_path: str, commits_path: str, source_topic: str, query: str = "dlq"):
    """Validate a batch once and write good rows to ``main`` and dead letters (original bytes
    and error headers) to ``dlq``; counters ``ok`` and ``routed``."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        main, dead = Table(log, "main", main_path), Table(log, "dlq", dlq_path)
        classified = dlq.classify(batch).persist()
        try:
            good, ok = _observed(dlq.valid_rows(classified).drop("error"))
            bad, routed = _observed(dlq.dead_letters(classified, source_topic))
            change = joined(main.append(state, good), dead.append(state, bad))
            return change | {"counters": {"ok": _seen(ok), "routed": _seen(routed)}}
        finally:
            classified.unpersist()
    return exactly_once(commits_path, query, body)


# ------------------------------------------- DLQ processor (DLQ3, DLQ4, ST2, AG6)
def dlq_recovery_sink(main_path: str, poison_path: str, commits_path: str, topic: str,
                      main_log: DataFrame | None = None, partition: Column | None = None,
                      num_partitions: int = 3, query: str = "dlq-recovery"):
    """Repair dead letters and put them back into the main topic (DLQ3, ST2); what cannot be
    repaired goes to a poison table (DLQ4).

    Recovered records get the offsets that follow those of ``main_log`` and of earlier batches,
    per partition; the next offsets are part of the commit, so a replayed or broken-off batch uses
    none up.  Both tables and the counters ``recovered`` and ``poison`` show together.  The
    batch has key, value, headers and, if the records keep it, timestamp."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        spark = batch.sparkSession
        main, dead = Table(log, "recovered", main_path), Table(log, "poison", poison_path)
        next_off = state["values"].get(f"next-{topic}")
        if next_off is None:
            rows = [] if main_log is None else logtable.next_offsets(
                main_log.filter(F.col("topic") == topic)).collect()      # one per log partition
            next_off = {str(r.partition): r.next_offset for r in rows}
        base = spark.createDataFrame([(topic, int(p), o) for p, o in next_off.items()],
                                     "topic string, partition int, next_offset long")
        batch = batch.persist()
        try:
            fixed = dlq.recover(batch)
            k = F.col("key").cast("string")
            records = logtable.to_records(
                fixed, topic, k, F.col("value"),
                F.col("timestamp") if "timestamp" in fixed.columns else F.lit(None).cast("timestamp"),
                partition if partition is not None else logtable.key_partition(k, num_partitions))
            back, recovered = _observed(logtable.assign_offsets(records, base=base))
            bad, poisoned = _observed(dlq.poison(batch))
            new, schema = main.write(back)
            seen = {**state, "schemas": schema}
            added = main.read(seen, folders=[f for fs in new.values() for f, _ in fs])
            last = {str(r.partition): r.next_offset for r in logtable.next_offsets(added).collect()}
            change = joined({"schemas": schema}, main.appended(seen, new), dead.append(state, bad))
            return change | {"values": {f"next-{topic}": {**next_off, **last}},
                             "counters": {"recovered": _seen(recovered), "poison": _seen(poisoned)}}
        finally:
            batch.unpersist()
    return exactly_once(commits_path, query, body)


# ------------------------------------------------------------ late rows (STR4)
def late_split_sink(main_path: str, late_path: str, commits_path: str, query: str = "late"):
    """Write the rows that :func:`logweave.streaming.jobs.tag_late` tagged to ``late``, the others
    to ``main``; counters ``on_time`` and ``late``."""
    def body(batch: DataFrame, batch_id: int, state: dict, log: CommitLog) -> dict:
        batch = batch.persist()
        try:
            change, totals = {}, {}
            for name, path, keep in (("main", main_path, ~F.col("late")), ("late", late_path, F.col("late"))):
                rows, n = _observed(batch.filter(keep).drop("late"))
                change = joined(change, Table(log, name, path).append(state, rows))
                totals["on_time" if name == "main" else "late"] = _seen(n)
            return change | {"counters": totals}
        finally:
            batch.unpersist()
    return exactly_once(commits_path, query, body)
