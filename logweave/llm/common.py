"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import checkpoint_dir

#: Fixed by the word definition: a word is a run of characters other than these.
SPACE = r"[\x20\x09-\x0D]+"

#: Rows per Arrow batch for the Python stages; texts can be long, so a batch
#: of the default 10,000 rows could outgrow a worker.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: the
    stages behind it run a single time, and its rows survive lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``staged`` with a unique row number ``rid``, so that repeated or null ids
    never merge two input rows."""
    return staged(df.withColumn("rid", F.monotonically_increasing_id()), label)


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, underscored until no column of ``df`` has one of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that reach Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def words(text: Column) -> Column:
    """The words of a text (runs of non-space characters); null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hash_sample(df: DataFrame, keys: list[str], n: int, total: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """At most ``n`` rows, the same on every run: the lowest by hash of ``keys``.

    With more than ``4 n`` rows a hash threshold first leaves about ``4 n``, so that
    the final ordering never gathers ``n`` rows of every partition."""
    total = df.count() if total is None else total
    h = F.xxhash64(*keys)
    if total > 4 * n:
        df = df.filter(F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(1 << 30)) < int(4 * n / total * (1 << 30)))
    return df.orderBy(h, *(order or keys)).limit(n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
