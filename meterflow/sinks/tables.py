"""Result tables as Parquet, with an arrival stamp and a stored sort order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.schemas import RESULT_TABLES, column_names


def stamped(rows: DataFrame, table: str) -> DataFrame:
    """The table's columns plus its arrival time, whole seconds or milliseconds."""
    ddl, stamp, _ = RESULT_TABLES[table]
    unit = "millisecond" if table in (
        "topology_inference_results", "anomaly_detection_results") else "second"
    return rows.select(*column_names(ddl), F.date_trunc(unit, F.current_timestamp()).alias(stamp))


def clustered(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the stored order, range partitioned so that file statistics allow skipping.

    The range covers the whole sort key, so one frequent meter still spreads over files. A key
    that is only the arrival stamp is constant within a write and needs no shuffle.
    """
    _, stamp, keys = RESULT_TABLES[table]
    ranged = [key for key in keys if key != stamp]
    return rows.repartitionByRange(*ranged).sortWithinPartitions(*keys) if ranged else rows


def append_table(rows: DataFrame, table: str, root: str) -> None:
    clustered(stamped(rows, table), table).write.mode("append").parquet(f"{root}/{table}")


def write_batch(
    rows: DataFrame, table: str, root: str, batch_id: int, folder: str | None = None,
) -> None:
    """Write one micro-batch, to the folder of the table's name if no other is given; a repeated batch replaces its own folder, so retries are safe.

    The rows are kept for the write: range partitioning samples them before it shuffles them,
    and stateful operators above must run once.
    """
    kept = stamped(rows, table).persist()
    try:
        clustered(kept, table).write.mode("overwrite").parquet(f"{root}/{folder or table}/batch_id={batch_id}")
    finally:
        kept.unpersist()


def read_table(
    spark: SparkSession, table: str, root: str, folder: str | None = None,
) -> DataFrame:
    """A result table written by either of the above."""
    ddl, stamp, _ = RESULT_TABLES[table]
    return spark.read.schema(f"{ddl}, {stamp} timestamp").parquet(f"{root}/{folder or table}").select(
        *column_names(ddl), stamp)


def start_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], name: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Run a function per micro-batch."""
    writer = (stream.writeStream.queryName(name).foreachBatch(each)
              .option("checkpointLocation", f"{checkpoint}/{name}"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_table(
    stream: DataFrame, table: str, root: str, checkpoint: str, available_now: bool = False,
    folder: str | None = None,
) -> StreamingQuery:
    """Append a stream to its result table."""
    return start_batches(
        stream, lambda rows, batch_id: write_batch(rows, table, root, batch_id, folder),
        folder or table, checkpoint, available_now)


def write_scored_csv(scored: DataFrame, path: str) -> None:
    """Scored windows as CSV with header, most anomalous first (kept in the order given)."""
    scored.write.mode("overwrite").option("header", True).csv(path)
