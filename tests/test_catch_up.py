"""A topology batch that spans many days, and the hierarchy file written in parallel."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import topology
from meterflow.operators.topology import topology_results
from meterflow.plans import queries
from meterflow.sinks.tables import read_table
from meterflow.streaming.topology_state import TopologyBatches


def test_batch_of_many_days_is_scored_before_old_hours_go(spark, tmp_path, monkeypatch):
    events = []
    for day in range(1, 13):
        events += [(f"m{day}", f"2024-01-{day:02d} 10:00:00", 2 * day, True, f"F{day}"),
                   ("u", f"2024-01-{day:02d} 10:01:00", 2 * day + 1, False, None)]
    given = spark.createDataFrame(
        [(m, t, s, h, f, "S", 24.0, 67.0) for m, t, s, h, f in events],
        "msn string, ts string, seq bigint, hierarchy_match boolean, feeder_name string, "
        "substation_name string, latitude double, longitude double").withColumn(
        "us", F.unix_micros(F.to_timestamp("ts")))
    monkeypatch.setattr(topology, "outage_occurrences", lambda rows: rows)
    TopologyBatches(str(tmp_path / "s"), str(tmp_path / "t"))(given, 0)
    columns = ["msn", "ts", "us", "seq", "hierarchy_match", "feeder_name", "substation_name", "latitude", "longitude"]
    want = topology_results(given.select(*columns)).count()
    got = read_table(spark, "topology_inference_results", str(tmp_path / "t"))
    assert got.count() == want >= 12


def test_hierarchy_file_has_several_parts_in_order(spark, monkeypatch):
    rows = spark.range(2000).select(
        F.col("id").alias("ordinal"),
        *[F.lit(None).cast("string").alias(c) for c in queries.column_names(queries.NETWORK_HIERARCHY)
          if c not in ("msn_normalized", "dtr_name")],
        F.concat(F.lit("M"), F.col("id") % 7).alias("msn_normalized"),
        F.col("id").cast("string").alias("dtr_name")).repartition(5)
    monkeypatch.setattr(queries.derive, "network_hierarchy", lambda *_: rows)
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for header in (True, False):
            read = queries._hierarchy_file(spark, "", header)
            assert len(read.inputFiles()) > 1
            last = {r.msn_normalized: int(r.dtr_name) for r in queries.enrich.hierarchy_lookup(read).collect()}
            assert last == {f"M{k}": max(n for n in range(2000) if n % 7 == k) for k in range(7)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
