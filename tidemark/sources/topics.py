"""Topic sources: Kafka where its package is loaded, Kafka-shaped files otherwise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Source settings every topic is read with.
STARTING_OFFSETS = "earliest"
POLL_TIMEOUT_MS = "120000"

# Columns of a Kafka source row that the decoders can use.
TOPIC_DDL = "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def kafka_options(
    bootstrap_servers: str,
    topic: str | Iterable[str],
    group_id: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a topic, or for several that share one subscription. ``extra`` takes e.g. ``maxOffsetsPerTrigger`` or ``minPartitions``,
    which keep the first batch of a long topic from being one huge batch."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic if isinstance(topic, str) else ",".join(topic),
        "startingOffsets": STARTING_OFFSETS,
        "kafkaConsumer.pollTimeoutMs": POLL_TIMEOUT_MS,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    options.update(extra or {})
    return options


def read_kafka_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str | Iterable[str],
    group_id: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    options = kafka_options(bootstrap_servers, topic, group_id, extra)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Kafka-shaped Parquet rows below ``path``."""
    reader = spark.readStream.schema(TOPIC_DDL)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def scan_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_DDL).parquet(path)


def write_topic_files(frames: DataFrame, path: str) -> None:
    """Add messages to a file topic."""
    frames.write.mode("append").parquet(path)


def scan_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Header CSV with a given schema (never inferred)."""
    return spark.read.csv(path, header=True, schema=ddl)
