"""Supply reliability kept up to date from the incident stream.

Each micro-batch leaves its own part of every summary (counts per level, counts per transformer,
the last status of its incidents), in a folder that a repeated batch replaces. Parts add up, so the
state of a summary is the sum of its parts. ``FAN`` parts are merged into one of the next level, ``FAN``
of those into one above, so a reader opens a few parts per level and a row is
written again once per level, not once per batch. Merged parts are not read again; nothing removes them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.operators import reliability
from meterflow.schemas import RESULT_TABLES, column_names

FAN = 16
INCIDENTS = RESULT_TABLES["outage_incident_events"][0]


@dataclass(frozen=True)
class Summary:
    """``of_log`` makes a part of some rows of the log, ``merged`` one part of several."""

    of_log: Callable[[DataFrame], DataFrame]
    merged: Callable[[DataFrame], DataFrame]
    ddl: str


SUMMARIES = {
    "levels": Summary(
        reliability.level_counts, reliability.merged_counts,
        "level string, name string, opened bigint, unresolved bigint, closed bigint, ms bigint, "
        "max_minutes double"),
    "network": Summary(
        reliability.network_counts, reliability.merged_network,
        "substation_name string, feeder_name string, dtr_name string, outages bigint, ms bigint"),
    "status": Summary(reliability.latest_per_incident, reliability.latest_per_incident, INCIDENTS),
}


def pieces(batches: int, fan: int) -> list[tuple[int, int, int]]:
    """``(level, first, end)``: the parts ``first`` to ``end`` of each level that make up batches 0 to ``batches`` - 1."""
    level, found = 0, []
    while batches:
        batches, rest = divmod(batches, fan)
        if rest:
            found.append((level, batches * fan, batches * fan + rest))
        level += 1
    return found


class ReliabilityTables:
    """The summaries below a folder. Batches count from 0; one writer."""

    def __init__(self, root: str, fan: int = FAN) -> None:
        self.root, self.fan = root, fan

    def owe(self, log: DataFrame) -> None:
        """Replace what a finished run owes: part of every reading, never merged into levels."""
        for name, summary in SUMMARIES.items():
            self._write(summary.of_log(log), name, f"{self.root}/{name}/owed")

    def update(self, log: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch. Parts of higher levels that it completes are written first, so
        that a reader who sees the batch finds them.
        """
        for name, summary in SUMMARIES.items():
            part = self._in_order(summary.of_log(log), name).persist()
            try:
                number, level, merged = batch_id, 0, part
                while (number + 1) % self.fan == 0:
                    first = number - self.fan + 1
                    merged = summary.merged(merged.union(
                        self._read(log.sparkSession, name, level, first, number)) if number > first else merged)
                    number, level = number // self.fan, level + 1
                    self._write(merged, name, self._folder(name, level, number))
                    merged = self._read(log.sparkSession, name, level, number, number + 1)
                self._write(part, name, self._folder(name, 0, batch_id))
            finally:
                part.unpersist()

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The summary of all batches so far and of what is owed."""
        newest = self._parts(spark, name, 0).agg(F.max("part")).first()[0]
        found = [] if newest is None else pieces(int(newest) + 1, self.fan)
        owed = spark.read.schema(SUMMARIES[name].ddl).parquet(f"{self.root}/{name}/owed")
        return SUMMARIES[name].merged(reduce(
            DataFrame.union, [self._read(spark, name, *piece) for piece in found], owed))

    def _in_order(self, rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*column_names(SUMMARIES[name].ddl))

    def _write(self, rows: DataFrame, name: str, path: str) -> None:
        self._in_order(rows, name).write.mode("overwrite").parquet(path)

    def _folder(self, name: str, level: int, part: int) -> str:
        return f"{self.root}/{name}/level{level}/part={part}"

    def _parts(self, spark: SparkSession, name: str, level: int) -> DataFrame:
        """All parts of a level; before the first batch there is a folder of none."""
        return spark.read.schema(f"{SUMMARIES[name].ddl}, part bigint").parquet(
            f"{self.root}/{name}/level{level}")

    def _read(self, spark: SparkSession, name: str, level: int, first: int, end: int) -> DataFrame:
        part = F.col("part")
        return self._in_order(self._parts(spark, name, level).where((part >= first) & (part < end)), name)

    def prepare(self, spark: SparkSession) -> None:
        """Folders to read from before the first batch; what an earlier run owed is taken back."""
        none = spark.createDataFrame([], INCIDENTS)
        self.owe(none)
        for name, summary in SUMMARIES.items():
            self._write(summary.of_log(none), name, self._folder(name, 0, -1))
