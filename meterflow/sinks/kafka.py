"""Kafka sinks: one JSON value per row, optionally keyed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.project import record_json


def kafka_records(rows: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` (JSON with nulls written out, times to the second) and, if asked for, ``key``."""
    value = record_json(rows).alias("value")
    return rows.select(value) if key is None else rows.select(
        F.col(key).cast("string").alias("key"), value)


def start_kafka(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None,
) -> StreamingQuery:
    """Publish a stream. Meter events are keyed by ``msn``, incidents by ``incident_id``."""
    return (
        kafka_records(stream, key).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", f"{checkpoint}/kafka-{topic}").start())


def write_kafka(rows: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Publish a table."""
    (kafka_records(rows, key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
