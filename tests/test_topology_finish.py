"""Evidence that comes in a later micro-batch than the outage it speaks for."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators.topology import topology_results
from meterflow.sinks.tables import read_table
from meterflow.streaming.topology_state import TopologyBatches


def test_evidence_of_a_later_batch_counts_once_finished(spark, tmp_path):
    """Two files that both span the day: the second brings evidence for outages of the first."""
    noon = 1_704_110_400_000_000
    minute = 60_000_000
    whole = spark.range(90).select(
        F.expr("concat(if(id % 3 = 0, 'u', 'k'), id % 7)").alias("msn"),
        (F.lit(noon) + F.col("id") * (2 * minute)).alias("us"), F.col("id").alias("seq"),
        (F.col("id") % 3 != 0).alias("hierarchy_match"), F.expr("concat('F', id % 4)").alias("feeder_name"),
        F.lit("S").alias("substation_name"), (28 + F.col("id") % 5 / 100).alias("latitude"),
        F.lit(77.0).alias("longitude"), F.lit("Power failure").alias("event_name"),
        F.lit("OCCURRENCE").alias("event_state"),
    ).withColumn("ts", F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd HH:mm:ss")).orderBy("seq")
    batches = TopologyBatches(str(tmp_path / "s"), str(tmp_path / "t"))
    want = topology_results(whole.select("msn", "ts", "us", "seq", "hierarchy_match", "feeder_name",
                                         "substation_name", "latitude", "longitude"))
    text = lambda frame, *drop: sorted(map(str, frame.drop("generated_at", *drop).collect()))
    read = lambda: text(read_table(spark, "topology_inference_results", str(tmp_path / "t")), "received_at")
    for batch_id in (0, 1):
        batches(whole.where(F.col("seq") % 4 < 2 if batch_id == 0 else F.col("seq") % 4 > 1), batch_id)
    assert read() != text(want)
    for _ in range(2):
        batches.finish(spark)
        assert read() == text(want)
