"""Topology inference per micro-batch against a table of recent evidence.

The evidence outlives a micro-batch as a table in shared storage, partitioned by hour and batch,
instead of as one list in one task. Each batch adds its known outages and then scores its unknown
outages with the batch operator over the hours that hold unknown outages and the hours before
them. Evidence counts once it has arrived, in the same or an earlier batch. After scoring, hours that lie far
behind the typical event of a batch are removed, and so are unknown outages whose evidence goes; hours that
the batch's own unknown outages need stay until the next batch. Files may bring evidence after the outages it
speaks for: ``finish`` scores those of a drained run again and replaces their results.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.functions import event_us
from meterflow.operators import topology
from meterflow.operators.skew import materialise
from meterflow.sinks.tables import read_table, write_batch

_HOUR_US = 3600 * 1_000_000
_COLUMNS = (
    "msn string, ts string, us bigint, seq bigint, hierarchy_match boolean, feeder_name string, "
    "substation_name string, latitude double, longitude double")
TABLE = "topology_inference_results"
KEEP_HOURS = 48


class TopologyBatches:
    """A ``foreachBatch`` function; ``state`` and ``root`` are folders all executors reach."""

    def __init__(
        self, state: str, root: str, output: str = TABLE, keep_hours: int = KEEP_HOURS,
    ) -> None:
        self.occurrences, self.root, self.output = f"{state}/occurrences", root, output
        self.keep_hours = keep_hours

    def _stored(self, spark: SparkSession, pattern: str) -> DataFrame | None:
        """Partitions matching a pattern, None if there are none."""
        reader = spark.read.schema(
            f"{_COLUMNS}, known boolean, hour int, batch_id bigint"
        ).option("basePath", self.occurrences)
        try:
            return reader.parquet(f"{self.occurrences}/{pattern}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _expire(
        self, spark: SparkSession, oldest_hour: int, batch_id: int, needed: set[int],
    ) -> None:
        """Remove evidence before an hour, except needed hours, and earlier batches' unknown outages that asked it."""
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.occurrences).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in files.globStatus(path(f"{self.occurrences}/known=true/hour=*")) or ():
            hour = int(folder.getPath().getName().partition("=")[2])
            if hour < oldest_hour and hour not in needed:
                files.delete(folder.getPath(), True)
        for folder in files.globStatus(path(f"{self.occurrences}/known=false/hour=*/batch_id=*")) or ():
            hour, batch = (int(part.getName().partition("=")[2])
                           for part in (folder.getPath().getParent(), folder.getPath()))
            if hour <= oldest_hour and batch < batch_id:
                files.delete(folder.getPath(), True)

    def __call__(self, enriched: DataFrame, batch_id: int) -> None:
        spark = enriched.sparkSession
        occurred = topology.outage_occurrences(enriched).withColumns({
            "known": F.col("hierarchy_match"),
            "hour": F.floor(F.col("us") / _HOUR_US).cast("int"),
            "batch_id": F.lit(batch_id).cast("bigint")})
        # A retried batch replaces its own partitions, here and in the result table.
        (occurred.repartition("known", "hour", F.pmod(F.xxhash64("msn"), F.lit(16)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("known", "hour", "batch_id").parquet(self.occurrences))
        hours = self._score(spark, batch_id)
        known = self._stored(spark, f"known=true/hour=*/batch_id={batch_id}")
        if known is not None:
            # The median, so that a few wrong clocks do not decide what is old.
            typical = known.agg(F.percentile_approx("hour", 0.5)).first()[0]
            if typical is not None:
                needed = {row.hour for row in hours.collect()} if hours is not None else set()
                self._expire(spark, typical - self.keep_hours, batch_id, needed)

    def _score(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Write the results of a batch; the hours of its unknown outages and those before them."""
        unknown = self._stored(spark, f"known=false/hour=*/batch_id={batch_id}")
        evidence = self._stored(spark, "known=true/hour=*/batch_id=*")
        if unknown is None or evidence is None:
            return None
        # One small row per hour; joined on the partition column, so other hours are not read.
        hours = unknown.select(F.explode(F.array("hour", F.col("hour") - 1)).alias("hour")).distinct()
        recent = evidence.where(F.col("batch_id") <= batch_id).join(hours, "hour", "left_semi")
        write_batch(
            topology.topology_results(recent.select(unknown.columns).unionByName(unknown)), TABLE,
            self.root, batch_id, self.output)
        return hours

    def finish(self, spark: SparkSession) -> None:
        """After a drained run: score outages again whose evidence came in a later batch than they did.

        Results are replaced by hour within the batch that wrote them; running and finishing again changes
        nothing more. Batches that came in order of time have none.
        """
        unknown = self._stored(spark, "known=false/hour=*/batch_id=*")
        evidence = self._stored(spark, "known=true/hour=*/batch_id=*")
        if unknown is None or evidence is None:
            return
        outrun: dict[int, list[int]] = {}
        for batch_id, hour in self._outrun(unknown, evidence).collect():
            outrun.setdefault(batch_id, []).append(hour)
        hour_of = F.floor(event_us(F.col("event_ts")) / _HOUR_US).cast("int")
        for batch_id, hours in sorted(outrun.items()):
            asking = unknown.where((F.col("batch_id") == batch_id) & F.col("hour").isin(hours))
            recent = evidence.where(F.col("hour").isin(hours + [hour - 1 for hour in hours]))
            results = topology.topology_results(recent.select(asking.columns).unionByName(asking))
            try:
                before = read_table(spark, TABLE, f"{self.root}/{self.output}", f"batch_id={batch_id}")
                results = results.unionByName(
                    before.where(~hour_of.isin(hours)).select(results.columns))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
            # Kept before the folder it was read from is replaced.
            write_batch(materialise(results), TABLE, self.root, batch_id, self.output)

    @staticmethod
    def _outrun(unknown: DataFrame, evidence: DataFrame) -> DataFrame:
        """``batch_id`` and ``hour`` of unknown outages that later batches brought evidence for; a row per hour."""
        spans = [rows.groupBy("batch_id", "hour").agg(F.min("us").alias("first"), F.max("us").alias("last"))
                 for rows in (unknown, evidence)]
        u, k = spans[0].alias("u"), spans[1].alias("k")
        return u.join(k, F.col("k.hour").between(F.col("u.hour") - 1, F.col("u.hour"))
                      & (F.col("k.batch_id") > F.col("u.batch_id")) & (F.col("k.first") <= F.col("u.last"))
                      & (F.col("k.last") >= F.col("u.first") - topology.LOOKBACK_US)
                      ).select("u.batch_id", "u.hour").distinct()
