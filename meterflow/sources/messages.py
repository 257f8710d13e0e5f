"""Readers of raw event messages and of stored result records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow import schemas
from meterflow.functions import blank_to_null


# Rows of a topic and files of a folder that one micro-batch takes; stateful operators hold the
# rows of one key of a batch.
MAX_OFFSETS, MAX_FILES = 1_000_000, 64


def kafka_options(servers: str, topic: str, start: str = "latest", group: str | None = None,
                  max_offsets: int | None = MAX_OFFSETS) -> dict[str, str]:
    """Options of a Kafka source; ``max_offsets`` bounds the rows of one micro-batch (None: all)."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
        "failOnDataLoss": "true"}
    if group is not None:
        options["kafka.group.id"] = group
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def _as_messages(records: DataFrame) -> DataFrame:
    """Payload text and an arrival order that is unique per topic.

    Offsets rise within a partition; a producer that keys by meter keeps each meter in one.
    """
    seq = F.shiftleft(F.col("partition").cast("bigint"), 44).bitwiseOR(F.col("offset"))
    return records.select(
        seq.alias("seq"), F.col("value").cast("string").alias("payload"),
        F.unix_micros("timestamp").alias("arrival_us"))


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as a stream of raw messages. Needs the Kafka connector on the class path."""
    return _as_messages(
        spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load())


def kafka_messages_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All records a topic holds now, as a table."""
    return _as_messages(
        spark.read.format("kafka").options(**kafka_options(servers, topic, "earliest")).load())


def typed_records(messages: DataFrame, ddl: str) -> DataFrame:
    """JSON records typed by a schema, e.g. of a result table, with the broken ones beside them.

    ``broken`` holds the payload of a record of which nothing could be read and whose columns are
    all null; it is null for good records.
    """
    # Generated from a one-record array, so that filters above do not parse again.
    fields = ", ".join(part.replace(" ", ": ", 1) for part in ddl.split(", "))
    read = messages.select(
        "payload", F.inline_outer(F.from_json("payload", f"array<struct<{fields}>>")))
    names = schemas.column_names(ddl)
    something = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in names])
    return read.select(*names, F.when(~something, F.col("payload")).alias("broken"))


def result_records(messages: DataFrame, table: str) -> DataFrame:
    """Records of one of the five result topics, broken ones beside them."""
    return typed_records(messages, schemas.RESULT_TABLES[table][0])


def _lines(text: DataFrame) -> DataFrame:
    return text.where(blank_to_null(F.col("value")).isNotNull()).withColumnRenamed(
        "value", "payload")


def jsonl_messages(spark: SparkSession, path: str) -> DataFrame:
    """One message per non-blank line; numbers rise within a split of a file, not across files.

    Where arrival order across files matters, number the messages from a payload field.
    """
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("seq"))
    return _lines(lines).select("seq", "payload")


def jsonl_message_stream(
    spark: SparkSession, path: str, max_files: int = MAX_FILES, number: str = "$.log_seq_no",
) -> DataFrame:
    """New JSON-lines files of a folder, numbered from a payload field.

    A stream has no line numbers of its own; rows without the field have a null ``seq``.
    """
    lines = _lines(spark.readStream.option("maxFilesPerTrigger", max_files).text(path))
    return lines.select(F.get_json_object("payload", number).cast("bigint").alias("seq"), "payload")


def training_features(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """Feature windows exported for training, as CSV with header or as Parquet."""
    reader = spark.read.schema(schemas.TRAINING_FEATURES)
    return reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path)
