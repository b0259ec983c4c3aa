"""Restarts and crashes of sinks, publishing and resumed streams; awkward rows of the
consuming join, JSON members, ratios and percentiles."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from logweave.functions import numeric, serde
from logweave.operators import exactly_once as eo
from logweave.operators import joins, metrics
from logweave.session import checkpoint_dir
from logweave.streaming import commits, jobs, sinks

TRANSFERS = "transfer_id string, txn_id long, amount double, off long"


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="logweave-restart-")


def _stage(spark, root, ids, part):
    spark.createDataFrame([(f"t{i}", 1, 1.0, i) for i in ids], TRANSFERS).coalesce(1) \
        .write.mode("append").parquet(f"{root}/staged/{part}")


def _dedup(spark, root, checkpoint):
    staged = spark.readStream.schema(TRANSFERS).parquet(f"{root}/staged/*")
    markers = spark.createDataFrame([(1, "commit")], "txn_id long, state string")
    return jobs.dedup_stream(spark, staged, markers, "transfer_id", f"{root}/ledger",
                             f"{root}/batches", checkpoint=checkpoint).count()


@pytest.mark.parametrize("same_checkpoint", [True, False])
def test_restarted_dedup_sees_new_rows(spark, root, same_checkpoint):
    _stage(spark, root, range(10), "a")
    assert _dedup(spark, root, f"{root}/c1") == 10
    _stage(spark, root, range(5, 30), "b")
    assert _dedup(spark, root, f"{root}/c1" if same_checkpoint else f"{root}/c2") == 30


def test_run_available_resumes(spark, root):
    for part, want in (("a", 10), ("b", 35)):
        _stage(spark, root, range(10) if part == "a" else range(25), part)
        src = spark.readStream.schema(TRANSFERS).parquet(f"{root}/staged/*")
        assert jobs.run_available(src, "copy", out=f"{root}/out",
                                  checkpoint=f"{root}/ckpt").count() == want


class Crash(Exception):
    pass


def _crash_on(monkeypatch, name):
    def fail(*a, **k):
        raise Crash
    monkeypatch.setattr(commits, name, fail)


CHANGE = ("off long, op string, before struct<id:long,status:string>, "
          "after struct<id:long,status:string>")


def test_cdc_replica_survives_a_crash_before_the_marker(spark, root, monkeypatch):
    fn = sinks.cdc_replica_sink(f"{root}/t", f"{root}/m")
    one = spark.createDataFrame([(i, "c", None, (i, "a")) for i in range(5)], CHANGE)
    two = spark.createDataFrame([(9, "u", (1, "a"), (1, "b")), (10, "d", (2, "a"), None)], CHANGE)
    fn(one, 0)
    with monkeypatch.context() as m:
        _crash_on(m, "commit_batch")
        with pytest.raises(Crash):
            fn(two, 1)
    read = lambda: {r.id: r.status for r in
                    sinks.read_replica(spark, f"{root}/t", f"{root}/m").collect()}
    assert read() == {i: "a" for i in range(5)}
    fn(two, 1)
    fn(two, 1)
    assert read() == {0: "a", 1: "b", 3: "a", 4: "a"}


@pytest.mark.parametrize("where", ["dead_letters", "commit_batch"])
def test_dlq_router_survives_a_crash_between_writes(spark, root, monkeypatch, where):
    fn = sinks.dlq_router(f"{root}/main", f"{root}/dlq", f"{root}/m", "dlq.orders.v1")
    good = b'{"order_id": "1", "customer": "c", "amount": 1}'
    raw = spark.createDataFrame([(0, "k", bytearray(good)), (1, "k", bytearray(b"x"))],
                                "off long, key string, value binary") \
        .withColumns({"offset": F.col("off"), "partition": F.lit(0)})
    with monkeypatch.context() as m:
        if where == "commit_batch":
            _crash_on(m, where)
        else:
            def fail(*a, **k):
                raise Crash
            m.setattr(sinks.dlq, where, fail)
        with pytest.raises(Crash):
            fn(raw, 0)
    assert sinks.read_table(spark, "main", f"{root}/main", f"{root}/m") is None
    fn(raw, 0)
    for t in ("main", "dlq"):
        assert sinks.read_table(spark, t, f"{root}/{t}", f"{root}/m").count() == 1


def test_publish_atomic_retry_shows_one_attempt(spark, root, monkeypatch):
    rows = spark.createDataFrame([(f"t{i}", i) for i in range(10)], "transfer_id string, off long")
    with monkeypatch.context() as m:
        def fail(*a, **k):
            raise Crash
        m.setattr(eo, "commit_marker", fail)
        with pytest.raises(Crash):
            eo.publish_atomic(rows.limit(4), 7, f"{root}/s", f"{root}/m")
    eo.publish_atomic(rows, 7, f"{root}/s", f"{root}/m")
    eo.publish_atomic(rows, 7, f"{root}/s", f"{root}/m")
    seen = eo.read_committed(spark.read.parquet(f"{root}/s"), spark.read.parquet(f"{root}/m"))
    assert seen.count() == 10


def test_stream_join_keeps_repeated_payments(spark, root):
    o = spark.createDataFrame([("a", 10_000.0)], "order_id string, order_epoch double")
    p = spark.createDataFrame([("a", 9_500.0), ("a", 10_010.0)],
                              "order_id string, payment_epoch double")
    for n, d in (("o", o), ("p", p)):
        d.write.parquet(f"{root}/{n}")
    read = lambda n, s: spark.readStream.schema(s).parquet(f"{root}/{n}")
    j = jobs.join_stream(read("o", o.schema), read("p", p.schema)).select("p.payment_epoch")
    assert [r[0] for r in jobs.run_available(j, "j", base=root).collect()] == [10_010.0]


@pytest.mark.parametrize("n", [1, 2, 4, 64])
def test_consume_on_match_keys_and_payloads(spark, n):
    big = 2**53 + 1
    o = spark.createDataFrame([("a", 0.0, big), ("b", 0.0, big + 2), (None, 0.0, 1), ("", 0.0, 2),
                               ("c", 0.0, 3), ("c", 100.0, None)],
                              "order_id string, t double, v long")
    p = spark.createDataFrame([("a", 5.0, big), ("b", -5.0, 7), (None, 1.0, 8), ("", 1.0, 9),
                               ("c", 300.0, 4)], "order_id string, t double, lo_t long")
    got = {(r.matched, r.key, r.l_v, r.r_lo_t) for r in joins.consume_on_match(
        o, p, "order_id", "t", "t", 300, num_partitions=n).collect()}
    assert got == {(True, "a", big, big), (True, "b", big + 2, 7), (False, "c", 3, None),
                   (True, "c", None, 4)}


def test_json_members(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    text = df.select(serde.encode_value(F.struct("a", "b")).cast("string")).first()[0]
    assert text == '{"a":1,"b":null}'
    v = serde.parse_json(F.lit('{"a.b": 5, "n": {"it\'s": {"x": 2}}, "bad": "q"}'))
    r = spark.range(1).select(
        serde.get_or_default(v, "a.b", "int", 0).alias("dot"), serde.to_number(v, "a.b").alias("num"),
        serde.nested(v, "n.it's.x", "int").alias("deep"), serde.to_number(v, "bad").alias("bad"),
        serde.get_or_default(v, "none", "int", 3).alias("none")).first()
    assert tuple(r) == (5, 5.0, 2, None, 3)


def test_ratio_of_large_counts(spark):
    cases = [(2**62, 3, 1), (10**18 + 1, 10**9 + 7, 3), (5 * 10**15, 7, 4), (0, 0, 2), (1, 2, 0)]
    for num, den, digits in cases:
        got = spark.range(1).select(numeric.ratio_round(F.lit(num).cast("bigint"),
                                                        F.lit(den).cast("bigint"), digits)).first()[0]
        want = 0.0 if not den else (2 * num * 10**digits + den) // (2 * den) / 10**digits
        assert got == want


def test_percentiles_of_ties_and_nothing(spark):
    same = spark.range(1000).select(F.lit("g").alias("g"), F.when(F.col("id") < 950, 1.5)
                                    .otherwise(F.col("id").cast("double")).alias("v"))
    r = metrics.nearest_rank_percentiles(same, ["g"], "v").first()
    assert (r.measured, r.p50, r.p95, r.p99, r.max) == (1000, 1.5, 1.5, 989.0, 999.0)
    none = metrics.nearest_rank_percentiles(same.limit(0), [], "v").collect()
    assert [tuple(x) for x in none] == [(0, 0.0, 0.0, 0.0, 0.0)]


def test_checkpoint_dir_must_be_shared_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
