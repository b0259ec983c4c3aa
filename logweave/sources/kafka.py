"""Kafka connection options (CFG1, SNK7, STR8) and Kafka source/sink helpers
(SRC1, SRC3, SRC5, SRC8, SNK1).

``connector_options`` turns Kafka client properties into what Spark's Kafka
source or sink accepts.  The consumer group id is dropped: a streaming query's
checkpoint owns its offsets.  The Kafka connector jar is
optional; ``read_kafka``/``write_kafka`` raise a clear error without it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Client defaults that results and delivery guarantees rely on.
SINK_DEFAULTS = {"kafka.acks": "all", "kafka.enable.idempotence": "true",
                 "kafka.retries": "5", "kafka.linger.ms": "5"}
SERVERS = "kafka.bootstrap.servers"
#: The connector refuses these: offsets and commits belong to the checkpoint.
REFUSED = frozenset({"kafka.group.id", "kafka.auto.offset.reset", "kafka.enable.auto.commit",
                     "kafka.key.deserializer", "kafka.value.deserializer",
                     "kafka.key.serializer", "kafka.value.serializer"})


def connector_options(servers: str, options: Mapping[str, object] = {}, *,
                      sink: bool = False, login: tuple[str, str] | None = None) -> dict[str, str]:
    """Options for Spark's Kafka source, or its sink.

    ``options`` are Kafka client properties, with or without the ``kafka.`` prefix;
    they win over the sink's defaults, and what the connector refuses is left out.
    ``login`` is (user, password) for SASL/PLAIN over TLS."""
    out = {SERVERS: servers, **(SINK_DEFAULTS if sink else {})}
    if login:
        user, password = (x.replace("\\", "\\\\").replace('"', '\\"') for x in login)
        out |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config":
                    "org.apache.kafka.common.security.plain.PlainLoginModule required "
                    f'username="{user}" password="{password}";'}
    for name, value in options.items():
        text = str(value).lower() if isinstance(value, bool) else str(value)
        out[name if name.startswith("kafka.") else f"kafka.{name}"] = text
    return {k: v for k, v in out.items() if k not in REFUSED}


def source_options(topics: str | Sequence[str], starting: str = "earliest",
                   read_committed: bool = False,
                   max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Subscription options (SRC1, SRC3, SRC8, STR8)."""
    t = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"subscribe": t, "startingOffsets": starting}
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def _kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(  # noqa: SLF001
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_kafka(spark: SparkSession, servers: str, topics: str | Sequence[str],
               options: Mapping[str, object] = {}, streaming: bool = True,
               login: tuple[str, str] | None = None, **subscription) -> DataFrame:
    """Kafka source (SRC1); ``subscription`` as in :func:`source_options`.  Needs
    the connector jar."""
    if not _kafka_available(spark):
        raise RuntimeError("spark-sql-kafka connector is not on the classpath")
    r = spark.readStream if streaming else spark.read
    return (r.format("kafka").options(**connector_options(servers, options, login=login))
            .options(**source_options(topics, **subscription)).load())


def write_kafka(df: DataFrame, servers: str, topic: str | None = None,
                options: Mapping[str, object] = {},
                login: tuple[str, str] | None = None) -> None:
    """Batch publish (SNK1/SNK2): a ``topic`` column wins over the option."""
    if "topic" not in df.columns and topic is None:
        raise ValueError("no topic given and no topic column")
    if not _kafka_available(df.sparkSession):
        raise RuntimeError("spark-sql-kafka connector is not on the classpath")
    w = df.write.format("kafka").options(**connector_options(servers, options, sink=True,
                                                             login=login))
    # Spark's ``topic`` option overrides a topic column, so the default is
    # passed only when rows carry no topic of their own.
    if topic is not None and "topic" not in df.columns:
        w = w.option("topic", topic)
    w.save()
