"""Logs, tables and states that grow: more rows make more files and tasks, never larger ones."""

from __future__ import annotations

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from logweave.plans import catalog
from logweave.streaming import commits, jobs


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="logweave-growth-")


def test_slices_grow_in_files_and_stay_batches(spark, root, monkeypatch):
    """A slice makes a file per ROWS_PER_FILE rows, and is a batch even if it is small or empty."""
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 20)
    sizes = [100, 3, 0, 30]
    rows = spark.createDataFrame([(s, i) for s, n in enumerate(sizes) for i in range(n)], "s long, i long")
    files = set(catalog._slices(rows, f"{root}/log", 4, F.col("s")))
    assert files == {5}
    assert len(spark.read.parquet(f"{root}/log").inputFiles()) == 20
    seen = []
    jobs.run_foreach(catalog._stream_of(spark, f"{root}/log", rows, files.pop()), "slices",
                     lambda batch, _: seen.append(sorted(r.s for r in batch.select("s").collect())), base=root)
    assert seen == [[s] * n for s, n in enumerate(sizes)]


def test_a_large_bucket_is_written_by_several_tasks(spark, root):
    rows = spark.range(0, 60_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    log = commits.CommitLog(spark, f"{root}/c")
    table = commits.Table(log, "t", f"{root}/t", "id", 1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        new, schema = table.write(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert list(new) == ["0"] and len(new["0"]) == 1
    got = table.read({"schemas": schema}, folders=[new["0"][0][0]])
    assert len(got.inputFiles()) > 2
    assert got.count() == got.distinct().count() == 60_000


def _consumed(batches, bound):
    """Matched and superseded records by one event after the other."""
    pending, out = {}, []
    for rows in batches:
        for key, t, side in sorted(rows):
            one = pending.setdefault(key, [None, None])
            if side == 0 and one[0] is not None:
                out.append((key, one[0], None))
            one[side] = t
            if None not in one and abs(one[0] - one[1]) <= bound:
                out.append((key, *pending.pop(key)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n_buckets", [1, 5])
def test_consuming_stream_equals_single_steps(spark, root, n_buckets):
    """Keys with repeated orders and payments among keys with one of each, over four batches."""
    rng = random.Random(5)
    schema = "order_id string, t double, side int"
    batches = [[(f"k{rng.randrange(60)}", float(rng.randrange(1000 * b, 1000 * b + 1000)), rng.randrange(2))
                for _ in range(80)] for b in range(4)]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/b{i}")
    read = lambda n, t: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/in/*").filter(F.col("side") == n).select("order_id", F.col("t").alias(t))
    out = jobs.run_available(jobs.consume_stream(
        read(0, "order_epoch"), read(1, "payment_epoch"), bound_s=300, delay="100 days",
        n_buckets=n_buckets), "single", base=root).collect()
    got = sorted(((r.key, r.order_t, r.payment_t) for r in out), key=str)
    want = _consumed(batches, 300)
    assert got == want and any(p is None for _, _, p in want)
    assert all(r.matched == (r.payment_json is not None) and r.order_json is not None for r in out)
