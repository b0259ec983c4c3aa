"""Session helpers: a tuned SparkSession for local runs and tests, and the
checkpoint directory lookup used by operators that cut lineage."""

from __future__ import annotations

import os
import sys
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the operators in this package.  AQE re-plans joins
# and coalesces shuffle partitions at runtime; the broadcast threshold is the
# size check that guards every implicit broadcast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Window and join state off the JVM heap, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Per-batch state checkpoints write the changes, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "logweave",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a SparkSession with the package defaults."""
    master = master or os.environ.get("LOGWEAVE_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not os.environ.get("PYSPARK_PYTHON"):
        # Python workers run the driver's interpreter (same pandas/pyarrow).
        conf.setdefault("spark.pyspark.python", sys.executable)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (local master: one machine) a scratch folder is created and registered; any
    other master raises, as executors could not read a driver-local folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - unknown key on some builds
            d = None
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="logweave-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
