"""The commit log and the sinks on it: fencing, order, crashes, cost of a batch."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from logweave.operators import dlq, metrics
from logweave.operators import eventsourcing as es
from logweave.sources import logtable
from logweave.streaming import commits, jobs, sinks

ROWS = "k long, v string"


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="logweave-commits-")


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def _published(spark, root):
    df = commits.read_published(spark, root)
    return [] if df is None else sorted((r.txn_id, r.k, r.v, r.epoch) for r in df.collect())


class Crash(Exception):
    pass


# ------------------------------------------------------------------ fencing
def test_names_are_taken_once(spark, root):
    assert commits.create_once(spark, f"{root}/a", "1")
    assert not commits.create_once(spark, f"{root}/a", "2")
    assert open(f"{root}/a").read() == "1"
    assert [n for n in os.listdir(root) if not n.endswith(".crc")] == ["a"]


@pytest.mark.parametrize("step", ["before", "written", "checked", "after"])
def test_two_writers_interleaved(spark, root, monkeypatch, step):
    """A second instance starts before the first publishes, when its rows are written, when it
    has checked its epoch, or after its commit: either the first one's commit came before the
    claim, or it is refused; the successor publishes what is missing and nothing twice."""
    first = commits.TransactionalWriter(spark, root, "p")
    second = []

    def start():
        if not second:
            second.append(commits.TransactionalWriter(spark, root, "p"))

    if step == "before":
        start()
    elif step == "written":
        write = commits.Table.write

        def write_then(self, rows):
            out = write(self, rows)
            start()
            return out
        monkeypatch.setattr(commits.Table, "write", write_then)
    elif step == "checked":
        append = commits.CommitLog._append

        def append_after(self, state, entry):
            if entry["kind"] == "commit":
                start()
            return append(self, state, entry)
        monkeypatch.setattr(commits.CommitLog, "_append", append_after)
    if step == "after":
        assert first.publish(_rows(spark, (1, "a")), 0)
        start()
    else:
        with pytest.raises(commits.Fenced):
            first.publish(_rows(spark, (1, "a")), 0)
    monkeypatch.undo()
    second[0].publish(_rows(spark, (1, "a")), 0)
    second[0].publish(_rows(spark, (2, "b")), 1)
    with pytest.raises(commits.Fenced):
        first.publish(_rows(spark, (9, "z")), 2)
    assert _published(spark, root) == [(0, 1, "a", 1 if step == "after" else 2), (1, 2, "b", 2)]


def test_order_does_not_follow_the_clock(spark, root, monkeypatch):
    """The successor's clock is behind: readers still see its commit as the last."""
    now = [2_000_000_000.0]
    monkeypatch.setattr(commits.time, "time", lambda: now[0])
    change = lambda off, v: spark.createDataFrame(
        [(off, "u", None, (1, v))], "off long, op string, before struct<id:long,v:string>, "
                                    "after struct<id:long,v:string>")
    sinks.cdc_replica_sink(f"{root}/t", f"{root}/c", query="a")(change(1, "old"), 0)
    now[0] = 1_000_000_000.0
    sinks.cdc_replica_sink(f"{root}/t", f"{root}/c", query="b")(change(2, "new"), 0)
    assert [r.v for r in sinks.read_replica(spark, f"{root}/t", f"{root}/c").collect()] == ["new"]


def test_replacing_commits_conflict_and_are_worked_out_again(spark, root):
    log = commits.CommitLog(spark, f"{root}/c")
    ea, eb = log.claim("a"), log.claim("b")
    base = log.state()["n"]
    assert log.commit("a", ea, 0, {"set": {"t": {"0": [["x", 0]]}}}, base)
    with pytest.raises(commits.Conflict):
        log.commit("b", eb, 0, {"set": {"t": {"0": [["y", 0]]}}}, base)
    assert log.commit("b", eb, 0, {"set": {"t": {"1": [["y", 0]]}}}, base)
    assert log.state()["tables"]["t"] == {"0": [["x", 0]], "1": [["y", 0]]}


def test_a_long_log_stays_small(spark, root):
    log = commits.CommitLog(spark, f"{root}/c")
    epoch = log.claim("w")
    for i in range(3 * commits.SNAPSHOT_EVERY + 5):
        assert log.commit("w", epoch, i, {"counters": {"n": 1}}, log.state()["n"])
    state = log.state()
    assert state["counters"] == {"n": 3 * commits.SNAPSHOT_EVERY + 5}
    assert state["n"] == 3 * commits.SNAPSHOT_EVERY + 6
    assert len([n for n in os.listdir(f"{root}/c") if n.endswith(".json")]) <= 2 * commits.SNAPSHOT_EVERY + 2
    assert not log.commit("w", epoch, 7, {"counters": {"n": 1}}, state["n"])


def test_appended_folders_are_merged(spark, root):
    w = commits.TransactionalWriter(spark, root, "w")
    for i in range(2 * commits.FANOUT + 1):
        w.publish(_rows(spark, (i, "x")), i)
    folders = w.table.folders(w.log.state())
    assert len(folders) < commits.FANOUT
    assert [r[1] for r in _published(spark, root)] == list(range(2 * commits.FANOUT + 1))


# ----------------------------------------------------------- upsert store (SNK4)
CHANGE = ("off long, op string, before struct<id:long,v:string>, after struct<id:long,v:string>")


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs
               if f.endswith(".parquet"))


def test_replayed_and_reordered_changes(spark, root):
    b1 = spark.createDataFrame([(1, "c", None, (1, "a")), (2, "c", None, (2, "a"))], CHANGE)
    b2 = spark.createDataFrame([(3, "u", (1, "a"), (1, "b")), (4, "d", (2, "a"), None)], CHANGE)
    for i, order in enumerate(([b1, b2, b1], [b2, b1], [b2, b1, b2, b1])):
        fn = sinks.cdc_replica_sink(f"{root}/t{i}", f"{root}/c{i}")
        for n, b in enumerate(order):
            fn(b, n)
        got = {r.id: r.v for r in sinks.read_replica(spark, f"{root}/t{i}", f"{root}/c{i}").collect()}
        assert got == {1: "b"}


def test_a_small_batch_writes_its_buckets_only(spark, root):
    big = spark.range(20_000).select(F.col("id").alias("off"), F.lit("c").alias("op"),
                                     F.lit(None).cast("struct<id:bigint,v:string>").alias("before"),
                                     F.struct("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).alias("after"))
    fn = sinks.cdc_replica_sink(f"{root}/t", f"{root}/c", n_buckets=32)
    fn(big, 0)
    whole = _bytes(f"{root}/t")
    fn(spark.createDataFrame([(99_999, "u", (5, ""), (5, "new"))], CHANGE), 1)
    assert _bytes(f"{root}/t") - whole < whole / 16
    rows = sinks.read_replica(spark, f"{root}/t", f"{root}/c")
    assert rows.count() == 20_000 and rows.filter("v = 'new'").count() == 1


# ------------------------------------------------------------------ fold (AG5)
@pytest.mark.parametrize("n_batches", [1, 2, 5])
def test_fold_equals_batch_after_every_batch(spark, root, n_batches):
    rows = []
    for a in range(12):
        rows += [(a, 0, "OrderCreated", 10.0 * a + 1), (a, 11, "PaymentReceived", 4.0),
                 (a, 12, "PaymentReceived", -1.0 if a % 3 == 0 else 10.0 * a)]
        if a % 4 == 0:
            rows.append((a, 100, "OrderShipped", None))
    events = spark.createDataFrame(rows, "aggregate_id long, seq long, event_type string, amount double")
    fn = sinks.fold_sink(f"{root}/e", f"{root}/s", f"{root}/c", n_buckets=3)
    so_far = events.limit(0)
    for b in range(n_batches):
        part = events.filter((F.col("seq") * 7 + F.col("aggregate_id")) % n_batches == b)
        fn(part, b)
        fn(part, b)
        so_far = so_far.unionByName(part)
        got = sinks.read_states(spark, f"{root}/s", f"{root}/c")
        key = lambda df: sorted(map(tuple, df.collect()), key=str)
        assert key(got) == key(es.fold_states(so_far).select(*got.columns))


def test_fold_reads_old_events_only_for_negative_payments(spark, root, monkeypatch):
    """A later batch is folded onto the states: it reads its own events, and of those before it only
    the buckets of aggregates in it that have a negative payment, now or before."""
    schema = "aggregate_id long, seq long, event_type string, amount double"
    batches = [
        [(a, 0, "OrderCreated", 10.0) for a in range(40)] + [(None, 0, "OrderCreated", 1.0)],
        [(a, 12, "PaymentReceived", 10.0) for a in range(40)],
        [(a, 11, "OrderShipped", None) for a in range(30)] + [(a, 14, "Noted", None) for a in range(30, 40)],
        [(7, 13, "PaymentReceived", -3.0)],
        [(7, 10, "PaymentReceived", 3.0)],
        [(a, 9, "PaymentReceived", 1.0) for a in range(8, 12)]]
    fn = sinks.fold_sink(f"{root}/e", f"{root}/s", f"{root}/c", n_buckets=4)
    log = commits.CommitLog(spark, f"{root}/c")
    asked = []
    read = commits.Table.read

    def spy(self, state=None, buckets=None, folders=None):
        if self.name == "events":
            asked.append(set(folders))
        return read(self, state, buckets, folders)
    monkeypatch.setattr(commits.Table, "read", spy)
    so_far = spark.createDataFrame([], schema)
    older = []
    for b, rows in enumerate(batches):
        part = spark.createDataFrame(rows, schema)
        before = set(commits.Table(log, "events", f"{root}/e").folders(log.state()))
        asked.clear()
        fn(part, b)
        older.append(len(set().union(*asked) & before))
        so_far = so_far.unionByName(part.filter("aggregate_id IS NOT NULL"))
        got = sinks.read_states(spark, f"{root}/s", f"{root}/c")
        assert got.columns == ["order_id", "status", "paid", "amount"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, es.fold_states(so_far).collect()))
    assert older[:3] == [0, 0, 0] and older[5] == 0     # no events of one with a negative payment
    assert 0 < older[3] <= 3 and 0 < older[4] <= 4      # of its bucket alone: a folder a batch


# ------------------------------------------------------------- ledger (SNK5)
def test_new_ids_read_no_ledger_folder(spark, root):
    fn = sinks.ledger_sink(f"{root}/l", f"{root}/c", "id", amount_col=None, n_buckets=4)
    batch = lambda lo, hi: spark.range(lo, hi).select(
        F.concat(F.lit("t"), F.col("id")).alias("id"), F.col("id").alias("off"))
    read = lambda: dict(sinks.counters(spark, f"{root}/c").collect())
    for i in range(12):
        fn(batch(1000 * i, 1000 * i + 40), i)
    assert read() == {"ledger_new": 480, "ledger_folders_read": read()["ledger_folders_read"]}
    assert read()["ledger_folders_read"] <= 2          # false alarms of the filters
    before = read()["ledger_folders_read"]
    fn(batch(2000, 2003), 12)                           # redelivered: their folders are read
    assert read()["ledger_new"] == 480
    assert 0 < read()["ledger_folders_read"] - before <= 6
    ids = [r.id for r in sinks.read_ledger(spark, f"{root}/l", f"{root}/c").collect()]
    assert len(ids) == len(set(ids)) == 480


# --------------------------------------------------------- DLQ processor (ST2)
def _dead(spark, lo, hi):
    bodies = ['{"order_id":"%d","customer":"x"}', "[1, %d]", "not json %d"]
    raw = spark.createDataFrame([(i, str(i), bytearray((bodies[i % 3] % i).encode())) for i in range(lo, hi)],
                                "off long, key string, value binary").withColumn("partition", F.lit(0))
    return dlq.dead_letters(dlq.classify(raw), "t")


@pytest.mark.parametrize("crash_at", [None, 0, 1, 2])
def test_recovery_shows_all_or_nothing(spark, root, monkeypatch, crash_at):
    main = logtable.assign_offsets(logtable.to_records(
        spark.range(5).select(F.lit("0").alias("k"), F.lit("{}").alias("v"), F.lit(0).alias("p")),
        "t", "k", "v", F.lit(None).cast("timestamp"), "p"))
    fn = sinks.dlq_recovery_sink(f"{root}/m", f"{root}/p", f"{root}/c", "t", main, F.lit(0))
    fn(_dead(spark, 0, 9), 0)
    if crash_at is not None:
        calls = [0]
        write = commits.Table.write

        def failing(self, rows):
            calls[0] += 1
            if calls[0] > crash_at:
                raise Crash
            return write(self, rows)

        with monkeypatch.context() as m:
            m.setattr(commits.Table, "write", failing)
            if crash_at == 2:
                m.setattr(commits, "commit_batch", lambda *a: (_ for _ in ()).throw(Crash()))
            with pytest.raises(Crash):
                fn(_dead(spark, 9, 18), 1)
        assert dict(sinks.counters(spark, f"{root}/c").collect()) == {"recovered": 3, "poison": 6}
    fn(_dead(spark, 9, 18), 1)
    got = sinks.read_table(spark, "recovered", f"{root}/m", f"{root}/c").collect()
    assert sorted(r.offset for r in got) == list(range(5, 11))
    assert sinks.read_table(spark, "poison", f"{root}/p", f"{root}/c").count() == 12
    assert dict(sinks.counters(spark, f"{root}/c").collect()) == {"recovered": 6, "poison": 12}


# ----------------------------------------------------- start at latest (SRC3)
def test_start_marks_do_not_move(spark, root):
    def add(lo, hi):
        rec = logtable.to_records(spark.range(lo, hi).select(F.col("id").cast("string").alias("k")),
                                  "t", "k", "k", F.timestamp_seconds(F.lit(0)),
                                  (F.col("k").cast("long") % 2).cast("int"))
        have = logtable.next_offsets(spark.read.schema(logtable.LOG_SCHEMA).parquet(f"{root}/log")) \
            if lo else None
        logtable.write_log(logtable.assign_offsets(rec, base=have), f"{root}/log")

    got = None
    for lo, hi in ((0, 10), (10, 14), (14, 20)):
        add(lo, hi)
        live = logtable.read_log_stream_latest(spark, f"{root}/log", f"{root}/marks", ["t"])
        got = jobs.run_available(live.select(F.col("key").cast("string").alias("k")), "latest",
                                 out=f"{root}/out", checkpoint=f"{root}/ckpt")
    assert sorted(int(r.k) for r in got.collect()) == list(range(10, 20))


# -------------------------------------------------------- expiry (JN3, JN4)
def test_buckets_hold_many_keys(spark, root):
    """Two buckets, many keys: matches, a superseded order, expiry by the watermark, and keys
    whose time has not come stay pending."""
    schema = "order_id string, t double, side int"
    slices = [[("a", 10.0, 0), ("b", 20.0, 0), ("b", 30.0, 0), ("c", 40.0, 1), ("", 50.0, 0), (None, 50.0, 0)],
              [("a", 100.0, 1), ("c", 330.0, 0), ("d", 400.0, 0)],
              [("z", 5_000.0, 0)], [("y", 5_100.0, 0)]]
    for i, rows in enumerate(slices):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{i}")
    read = lambda n, t: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/in/*").filter(F.col("side") == n).select("order_id", F.col("t").alias(t))
    out = jobs.run_available(jobs.consume_stream(read(0, "order_epoch"), read(1, "payment_epoch"), n_buckets=2),
                             "expiry", base=root).collect()
    assert sorted((r.key, r.order_t, r.payment_t) for r in out if r.matched) == [("a", 10.0, 100.0), ("c", 330.0, 40.0)]
    assert sorted((r.key, r.order_t) for r in out if not r.matched) == [("b", 20.0), ("b", 30.0), ("d", 400.0)]


# -------------------------------------------------------------- report (SNK8)
@pytest.mark.parametrize("text, rows", [(None, 0), ("", 0), ("[]", 0), ("{}", 0), ("no json", 0),
                                        ('[{"config": "b", "count": 1234567, "elapsed_s": 2.5, "msg_per_s": 1000.5, '
                                         '"mb_per_s": 0.125}, {}]', 2)])
def test_report_sections(spark, root, text, rows):
    if text is not None:
        open(f"{root}/t.json", "w").write(text)
    open(f"{root}/l.json", "w").write(json.dumps({"measured": 3, "p50_ms": 1.5}, indent=2))
    lines = [r.line for r in metrics.report_document(spark, f"{root}/t.json", f"{root}/l.json")
             .orderBy("line_no").collect()]
    assert lines[:3] == ["# Benchmark Report", "", "## Producer throughput (sweep)"]
    assert lines[-7:] == ["|---|---:|", "| measured | 3 |", "| P50 | 1.5 |", "| P95 | 0.0 |", "| P99 | 0.0 |",
                          "| max | 0.0 |", ""]
    if rows:
        assert lines[6:8] == ["| b | 1,234,567 | 2.5 | 1,000 | 0.13 |", "| ? | 0 | 0.0 | 0 | 0.00 |"]
    else:
        assert lines[4] == "_No throughput results._"
    gone = [r.line for r in metrics.report_document(spark, f"{root}/x", f"{root}/y").collect()]
    assert "_No latency results._" in gone and len(gone) == 10
