"""File-backed message log with the Kafka record schema (D1, D2, SRC1-SRC4,
SRC6, SRC9, SNK1-SNK3, ST1).

A log is a Parquet directory of records ``key BINARY, value BINARY, topic,
partition INT, offset BIGINT, timestamp TIMESTAMP, headers``.  The same
operators therefore run on a Kafka source (``sources.kafka``) and on a log
table.  Offsets are dense per partition; they are assigned in parallel from a
range shuffle (no per-partition window that would put a whole log partition
into one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logweave.functions.materialize import computed
from logweave.functions.serde import (decode_key, decode_value, encode_value, member_path,
                                      parse_json)
from logweave.operators.scan import global_positions

HEADER = T.StructType([T.StructField("key", T.StringType()),
                       T.StructField("value", T.BinaryType())])
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(HEADER)),
])
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_partition(key: Column, num_partitions: int) -> Column:
    """Key -> partition routing (SNK3): equal keys always share a partition."""
    return F.pmod(F.hash(key), F.lit(num_partitions)).cast("int")


def to_records(df: DataFrame, topic: str | Column | None, key: Column | str | None,
               value: Column | str, timestamp: Column | str,
               partition: Column | str | None = None, num_partitions: int = 3,
               headers: Column | None = None) -> DataFrame:
    """Shape rows as log records without offsets (SNK1, SNK2).

    ``value`` may be a struct/map/array (JSON-encoded), a string or bytes;
    ``topic`` is a literal default or a per-row column (a ``topic`` column
    wins); with neither a ``ValueError`` is raised.
    """
    if topic is None and "topic" not in df.columns:
        raise ValueError("no topic given and no topic column")
    t = _c(topic) if isinstance(topic, Column) else (
        F.col("topic") if "topic" in df.columns else F.lit(topic))
    v = _c(value)
    vtype = df.select(v).schema[0].dataType
    vt = ("binary" if isinstance(vtype, T.BinaryType)
          else "string" if isinstance(vtype, T.StringType) else None)
    k = None if key is None else _c(key)
    kb = (F.lit(None).cast("binary") if k is None
          else F.when(k.isNotNull(), encode_value(k.cast("string"), "string")))
    part = (_c(partition).cast("int") if partition is not None
            else (key_partition(k, num_partitions) if k is not None
                  else F.lit(0).cast("int")))
    return df.select(kb.alias("key"), encode_value(v, vt).alias("value"),
                     t.alias("topic"), part.alias("partition"),
                     _c(timestamp).cast("timestamp").alias("timestamp"),
                     (headers if headers is not None
                      else F.lit(None).cast(T.ArrayType(HEADER))).alias("headers"))


def assign_offsets(records: DataFrame, order: Sequence[str] = ("timestamp",),
                   base: DataFrame | None = None) -> DataFrame:
    """Dense per-partition offsets in ``(topic, partition, *order)`` order.

    ``base`` (topic, partition, next_offset) continues an existing log; it has
    one row per log partition.  Ties in ``order`` are broken by key and value.
    """
    keys = ["topic", "partition", *order, "key", "value"]
    pos = global_positions(records, keys)
    starts = pos.groupBy("topic", "partition").agg(F.min("_pos").alias("_p0"))
    out = pos.join(starts, ["topic", "partition"])
    off = F.col("_pos") - F.col("_p0")
    if base is not None:
        out = out.join(base, ["topic", "partition"], "left")
        off = off + F.coalesce(F.col("next_offset"), F.lit(0))
    return out.withColumn("offset", off.cast("bigint")).select(*LOG_COLUMNS)


def write_log(records: DataFrame, path: str, mode: str = "append",
              num_files: int | None = None) -> None:
    """Append records to a log directory, one sub-directory per topic.

    Files are cut by a range shuffle on ``(topic, partition, offset)``: each
    file holds one contiguous offset range, and a large log partition is
    spread over many writers instead of one task per log partition."""
    n = num_files or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (records.select(*LOG_COLUMNS)
     .repartitionByRange(n, "topic", "partition", "offset")
     .sortWithinPartitions("topic", "partition", "offset")
     .write.mode(mode).partitionBy("topic").parquet(path))


def next_offsets(log: DataFrame) -> DataFrame:
    """Per (topic, partition), the offset the next record gets."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def read_log(spark: SparkSession, path: str, topics: Sequence[str] | None = None) -> DataFrame:
    """Full-log batch read (SRC2); topic selection prunes directories."""
    df = spark.read.parquet(path)
    if topics:
        df = df.filter(F.col("topic").isin(list(topics)))
    return df.select(*LOG_COLUMNS)


def read_log_stream(spark: SparkSession, path: str, topics: Sequence[str] | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to one or many topics of a log directory (SRC1, SRC6):
    every streaming query with its own checkpoint is an independent group."""
    r = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    if topics:
        df = df.filter(F.col("topic").isin(list(topics)))
    return df


def starting_from(log: DataFrame, position: str = "earliest",
                  snapshot: DataFrame | None = None) -> DataFrame:
    """Start position (SRC3).  ``earliest`` keeps everything; ``latest``
    keeps records after the per-partition high-water mark of ``snapshot``
    (the log as it was when the consumer started)."""
    if position == "earliest":
        return log
    if position != "latest":
        raise ValueError(f"unknown start position: {position}")
    if snapshot is None:
        raise ValueError("latest needs the log snapshot taken at start")
    marks = next_offsets(snapshot)          # one row per log partition
    return (log.join(marks, ["topic", "partition"], "left")
            .filter(F.col("offset") >= F.coalesce(F.col("next_offset"), F.lit(0)))
            .drop("next_offset"))


def start_marks(spark: SparkSession, path: str, marks_path: str) -> DataFrame:
    """The next offset of every log partition when a group first started at ``latest``:
    topic, partition, next_offset.

    They are written once, under ``marks_path`` (kept beside the group's checkpoint), and
    read from there ever after, so a restart does not move the start.  Whoever writes them
    first wins; a broken-off write has no success file and is not taken."""
    def marks() -> DataFrame:
        return spark.read.schema("topic string, partition int, next_offset long").parquet(marks_path)

    def done() -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{marks_path}/_SUCCESS")  # noqa: SLF001
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001

    if not done():
        log = spark.read.schema(LOG_SCHEMA).parquet(path)
        next_offsets(log).coalesce(1).write.mode("overwrite").parquet(marks_path)
    return marks()


def read_log_stream_latest(spark: SparkSession, path: str, marks_path: str,
                           topics: Sequence[str] | None = None,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Subscribe from ``latest`` (SRC3): records that were in the log when the group first
    started are never delivered, all later ones are, also after restarts.  A log partition that
    did not exist then is read from its beginning.  The marks hold one row per log partition."""
    marks = start_marks(spark, path, marks_path)
    log = read_log_stream(spark, path, topics, max_files_per_trigger)
    return (log.join(marks, ["topic", "partition"], "left")
            .filter(F.col("offset") >= F.coalesce(F.col("next_offset"), F.lit(0)))
            .select(*LOG_COLUMNS))


def first_n(log: DataFrame, n: int) -> DataFrame:
    """Bounded consumption: the first ``n`` records in log order (SRC4).
    A top-n (each task keeps its best n), not a sort of the whole log."""
    return log.orderBy("timestamp", "partition", "offset").limit(n)


def metadata(log: DataFrame, payload_fields: dict[str, str] | None = None) -> DataFrame:
    """Message metadata projection (SRC9): key (text), partition, offset,
    timestamp (epoch s) and selected payload fields (``name -> type``)."""
    parsed = computed(log, {"_v": parse_json(F.when(F.is_valid_utf8("value"),
                                                    F.col("value").cast("string")))})
    cols = [decode_key("key").alias("key"), "partition", "offset",
            (F.unix_micros("timestamp") / F.lit(1e6)).alias("ts")]
    for name, typ in (payload_fields or {}).items():
        cols.append(F.try_variant_get("_v", member_path(name), typ).alias(name))
    return parsed.select(*cols)


def union_topics(*logs: DataFrame) -> DataFrame:
    """One consumer over several topics (ST1): the topic column is kept."""
    out = logs[0]
    for d in logs[1:]:
        out = out.unionByName(d)
    return out


def tag_topic(df: DataFrame, topic: str) -> DataFrame:
    """Add a literal ``topic`` column (a single-topic source for ST1)."""
    return df.withColumn("topic", F.lit(topic))


def per_key_order(partition_col: str = "partition", offset_col: str = "offset"):
    """Window spec ordering one key's records by log position (D4)."""
    return Window.partitionBy("key").orderBy(partition_col, offset_col)


def decode_messages(log: DataFrame, value_col: str = "value", out: str = "msg") -> DataFrame:
    """Consumer-side best-effort decode (FN1) as a column ``out``
    (struct<kind, text, json, raw>), evaluated once per record.  Field
    accesses and filters on ``out`` reuse the one parse instead of repeating
    it (see :mod:`logweave.functions.materialize`)."""
    return computed(log, {out: decode_value(value_col)})
