from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from meterflow.operators.features import meter_features
from meterflow.operators.outage import outage_incidents
from meterflow.operators.topology import outage_occurrences, topology_results
from meterflow.plans.batch import enriched_events
from meterflow.plans.demo_model import DEMO_MODEL
from meterflow.sinks.tables import read_table, write_batch
from meterflow.sources.messages import jsonl_message_stream, jsonl_messages
from meterflow.streaming import jobs
from meterflow.streaming.outage_state import outage_stream
from meterflow.streaming.topology_state import TopologyBatches


@pytest.fixture(scope="module")
def lookups(spark):
    catalogue = spark.createDataFrame(
        [(0, 1, 1, "Power failure", "OCCURRENCE"), (1, 2, 1, "Power failure", "RESTORATION")],
        "ordinal int, event_id int, event_tblrefid int, event_name string, event_state string"
    ).withColumns({
        "isrestoration": F.lit(False), "priorityname": F.lit("p"),
        "eventclassification_name": F.lit("c"), "event_description": F.lit("d")})
    hierarchy = spark.createDataFrame(
        [(i, f"K{i}", f"D{i}", "C", f"F{i % 3}", "S") for i in range(8)],
        "ordinal int, msn_normalized string, dtr_name string, dtr_network_code string, "
        "feeder_name string, substation_name string")
    return catalogue, hierarchy


def events(count=120):
    for i in range(count):
        meter = f"k{i % 8}" if i % 5 else f"u{i % 3}"
        yield {"msn": meter, "evnt_id": 1 + (i // 9) % 2, "log_seq_no": i, "v_r": 230 + i % 7,
               "ts": f"2024-01-01 {10 + i // 60:02d}:{i % 60:02d}:00",
               "latitude": 28 + i % 8 / 100, "longitude": 77.0}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Four files, to be read one per micro-batch in this order."""
    path = tmp_path_factory.mktemp("events")
    rows = list(events())
    for part in range(4):
        file = path / f"part{part}.json"
        file.write_text("\n".join(json.dumps(r) for r in rows[part * 30:(part + 1) * 30]))
        os.utime(file, (time.time() - 100 + part,) * 2)
    return str(path)


def numbered(messages):
    return messages.drop("seq").withColumn(
        "seq", F.get_json_object("payload", "$.log_seq_no").cast("bigint"))


def stream(spark, folder, lookups):
    return enriched_events(jsonl_message_stream(spark, folder, max_files=1), *lookups)


def table(spark, folder, lookups):
    return enriched_events(numbered(jsonl_messages(spark, folder)), *lookups)


def rows(frame, *drop):
    return sorted(map(str, frame.drop(*drop).collect()))


def test_use_cases_match_batch_over_several_batches(spark, folder, lookups, tmp_path):
    target = jobs.Target(str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    running = jobs.start_use_cases(
        stream(spark, folder, lookups),
        [jobs.UseCase("outage-intelligence", True, "incidents"), *jobs.DEFAULT_USE_CASES[1:]],
        DEMO_MODEL, target)
    running.append(jobs.start_processed(stream(spark, folder, lookups), target))
    for query in running:
        query.awaitTermination()
    jobs.finish_outages(spark, target, "incidents")
    whole = table(spark, folder, lookups)
    incidents = read_table(spark, "outage_incident_events", target.root, "incidents")
    assert rows(incidents, "received_at") == rows(outage_incidents(whole))
    assert incidents.where("incident_status = 'UNRESOLVED'").count() > 0
    inferred = read_table(spark, "topology_inference_results", target.root)
    want = topology_results(outage_occurrences(whole))
    assert rows(inferred, "received_at", "generated_at") == rows(want, "generated_at")
    assert inferred.count() > 0
    done = F.lit("2024-01-01 11:45:00").cast("timestamp")  # last event 11:59, less five seconds
    got = read_table(spark, "meter_features_15m", target.root)
    assert rows(got, "ingested_at") == rows(meter_features(whole).where(F.col("window_end") <= done))
    assert read_table(spark, "anomaly_detection_results", target.root).count() == got.count()
    assert read_table(spark, "processed_events", target.root).count() == 120


def test_late_rows_miss_the_window_but_not_the_processed_table(spark, lookups, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    for i, ts in enumerate(["10:00:00", "10:31:00", "10:32:00", "10:01:00", "11:00:00"]):
        file = folder / f"{i}.json"
        file.write_text(json.dumps({"msn": "k1", "ts": f"2024-01-01 {ts}", "log_seq_no": i}))
        os.utime(file, (time.time() - 100 + i,) * 2)
    target = jobs.Target(str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    source = stream(spark, str(folder), lookups)
    jobs.start_features(source, target).awaitTermination()
    jobs.start_processed(source, target).awaitTermination()
    got = {str(r["window_start"])[11:16]: r["event_count_15m"]
           for r in read_table(spark, "meter_features_15m", target.root).collect()}
    assert got == {"10:00": 1, "10:30": 2}
    assert read_table(spark, "processed_events", target.root).count() == 5


def test_unresolved_alert_fires_once_and_closing_still_works(spark, lookups, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def put(name, state, ts):
        # Renamed into place, so that the stream never sees half a file.
        text = json.dumps({"msn": "k1", "evnt_id": state, "ts": ts, "log_seq_no": int(name)})
        (tmp_path / name).write_text(text)
        (tmp_path / name).rename(source / f"{name}.json")

    put("1", 1, "2024-01-01 10:00:00")
    messages = jsonl_message_stream(spark, str(source))
    query = (
        outage_stream(enriched_events(messages, *lookups), alert_after_us=2_000_000, wall_clock=True).writeStream
        .format("memory").queryName("alerts").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start())

    def statuses():
        return [r["incident_status"] for r in spark.table("alerts").collect()]

    def wait_for(wanted):
        until = time.time() + 90
        while time.time() < until and statuses() != wanted:
            time.sleep(0.5)
        assert statuses() == wanted

    try:
        wait_for(["OPEN", "UNRESOLVED"])
        time.sleep(3)
        assert statuses() == ["OPEN", "UNRESOLVED"]
        put("2", 2, "2024-01-01 10:07:00")
        wait_for(["OPEN", "UNRESOLVED", "CLOSED"])
        closed = spark.table("alerts").where("incident_status = 'CLOSED'").first()
        assert closed["duration_minutes"] == 7.0 and closed["dtr_name"] == "D1"
    finally:
        query.stop()


def test_repeated_topology_batch_leaves_the_same_state(spark, folder, lookups, tmp_path):
    whole = table(spark, folder, lookups)
    batches = TopologyBatches(str(tmp_path / "s"), str(tmp_path / "t"))
    results = []
    for batch_id in (0, 1, 1):
        part = whole.where((F.col("seq") >= 60) == bool(batch_id))
        batches(part, batch_id)
        results.append(rows(read_table(spark, "topology_inference_results", str(tmp_path / "t")),
                            "received_at", "generated_at"))
    assert results[1] == results[2]
    assert results[2] == rows(topology_results(outage_occurrences(whole)), "generated_at")


def test_one_wrong_clock_changes_nothing_else(spark, lookups, folder, tmp_path):
    """An unknown outage dated 2000 finds no evidence and removes none; old hours expire."""
    whole = table(spark, folder, lookups)
    odd = whole.where("seq = 5").withColumns({
        "ts": F.lit("2000-01-01 10:00:00"), "seq": F.lit(10_000).cast("bigint")})
    batches = TopologyBatches(str(tmp_path / "s"), str(tmp_path / "t"), keep_hours=1)
    batches(whole.where("seq < 60"), 0)
    batches(whole.where("seq >= 60").unionByName(odd), 1)
    got = read_table(spark, "topology_inference_results", str(tmp_path / "t"))
    assert rows(got, "received_at", "generated_at") == rows(
        topology_results(outage_occurrences(whole)), "generated_at")
    later = whole.withColumn("ts", F.concat(F.lit("2024-02-01"), F.substring("ts", 11, 9)))
    batches(later, 2)
    hours = [f.name for f in (tmp_path / "s" / "occurrences" / "known=true").iterdir()]
    assert hours and all(int(h.partition("=")[2]) > 474_000 for h in hours if "=" in h)


def test_stateful_operator_runs_once_per_batch(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows_ = spark.range(1000, numPartitions=4).select(
        F.concat(F.lit("m"), F.col("id")).alias("msn"), F.timestamp_seconds("id").alias("window_start"),
        F.timestamp_seconds("id").alias("window_end"), F.col("id").alias("event_count_15m"),
        F.lit(1.0).alias("avg_voltage_15m"), F.lit(1.0).alias("voltage_range_15m"),
        F.col("id").alias("power_failure_count_15m"))
    write_batch(rows_.mapInPandas(count, rows_.schema), "meter_features_15m", str(tmp_path), 0)
    assert seen.value == 1000
