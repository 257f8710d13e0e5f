from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from meterflow import session
from meterflow.operators.enrich import hierarchy_lookup
from meterflow.schemas import METER_FEATURES, RESULT_TABLES
from meterflow.sinks import kafka, tables
from meterflow.sources import lookups, messages
from meterflow.streaming import jobs


def test_lookup_csv_by_name(spark, tmp_path):
    path = tmp_path / "net.csv"
    path.write_text(
        "﻿feeder_name, msn_normalized ,substation_name,dtr_name,dtr_network_code\n"
        "F0,m1,S0,D0,C0\n F1 , M1 ,,D1,C1\nF2,  ,S2,D2,C2\n", encoding="utf-8")
    rows = lookups.network_hierarchy(spark, str(path))
    assert rows.where("feeder_name = 'F1'").first()["substation_name"] is None
    found = hierarchy_lookup(rows).collect()
    assert [(r["msn_normalized"], r["feeder_name"]) for r in found] == [("M1", "F1")]


def test_lookup_csv_bad_cells(spark, tmp_path):
    path = tmp_path / "cat.csv"
    path.write_text("event_id,event_tblrefid,event_name,isrestoration\n7,x,Power failure,true\n, 1,N,\n")
    first, second = lookups.event_catalogue(spark, str(path)).orderBy("event_name").collect()[::-1]
    assert (first["event_id"], first["event_tblrefid"], first["isrestoration"]) == (7, None, True)
    assert second["event_id"] is None and second["event_tblrefid"] == 1
    assert first["priorityname"] is None
    plain = tmp_path / "pos.csv"
    plain.write_text("S,F,D,C,m,M\nS,F\n")
    assert lookups.network_hierarchy(spark, str(plain), header=False).count() == 2


def test_jsonl(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text('{"msn":"a"}\n\n  \n{"msn":"b"}\n')
    rows = messages.jsonl_messages(spark, str(path)).orderBy("seq").collect()
    assert [json.loads(r["payload"])["msn"] for r in rows] == ["a", "b"]


def test_training_csv(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text(
        "msn,window_start,event_count_15m,avg_voltage_15m,voltage_range_15m,power_failure_count_15m\n"
        "a,2024-01-01 10:00:00,2,230.5,,0\n")
    row = messages.training_features(spark, str(path)).first()
    assert (row["event_count_15m"], row["voltage_range_15m"]) == (2, None)


def test_kafka_options_and_records(spark):
    options = messages.kafka_options("host:9092", "events", "earliest", "group", 1000)
    assert options["subscribe"] == "events" and options["maxOffsetsPerTrigger"] == "1000"
    rows = spark.createDataFrame([("m", None)], "msn string, v_r double")
    record = kafka.kafka_records(rows, "msn").first()
    assert record["key"] == "m" and json.loads(record["value"]) == {"msn": "m", "v_r": None}
    assert kafka.kafka_records(rows).columns == ["value"]


def test_record_topic_is_typed(spark):
    rows = spark.createDataFrame([('{"incident_id":"i","event_tblrefid":1}',), ("{bad",)], "payload string")
    got = messages.result_records(rows, "outage_incident_events").collect()
    assert [(r["incident_id"], r["event_tblrefid"], r["end_ts"], r["broken"]) for r in got] == [
        ("i", 1, None, None), (None, None, None, "{bad")]


def test_records_write_times_to_the_second(spark):
    rows = features_frame(spark, 1)
    record = json.loads(kafka.kafka_records(rows, "msn").first()["value"])
    assert record["window_start"] == "1970-01-01 00:00:00" and record["window_end"] == "1970-01-01 00:15:00"


def test_shared_folder_must_be_named_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def features_frame(spark, count=50):
    return spark.range(count).select(
        F.concat(F.lit("m"), F.col("id") % 3).alias("msn"),
        F.timestamp_seconds(F.col("id") * 900).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 900 + 900).alias("window_end"),
        F.lit(1).cast("bigint").alias("event_count_15m"), F.lit(1.0).alias("avg_voltage_15m"),
        F.lit(None).cast("double").alias("voltage_range_15m"),
        F.lit(0).cast("bigint").alias("power_failure_count_15m"))


def test_tables_are_sorted_and_retries_replace(spark, tmp_path):
    rows, table = features_frame(spark), "meter_features_15m"
    tables.append_table(rows, table, str(tmp_path / "a"))
    tables.append_table(rows, table, str(tmp_path / "a"))
    stored = tables.read_table(spark, table, str(tmp_path / "a"))
    assert stored.count() == 100 and stored.columns[-1] == "ingested_at"
    for _ in range(2):
        tables.write_batch(rows, table, str(tmp_path / "b"), 3)
    assert tables.read_table(spark, table, str(tmp_path / "b")).count() == 50
    files = spark.read.schema(METER_FEATURES).parquet(str(tmp_path / "b" / table))
    placed = files.select(F.input_file_name().alias("f"), "msn", "window_start",
                          F.monotonically_increasing_id().alias("i")).orderBy("i").collect()
    for before, after in zip(placed, placed[1:]):
        if before["f"] == after["f"]:
            assert (before["msn"], before["window_start"]) <= (after["msn"], after["window_start"])


def test_every_result_table_has_its_sort_columns():
    for ddl, stamp, keys in RESULT_TABLES.values():
        names = [part.split()[0] for part in ddl.split(", ")] + [stamp]
        assert set(keys) <= set(names)


def test_use_case_registry(spark):
    text = json.dumps({"plugins": [
        {"name": "outage-intelligence", "enabled": True, "className": "x", "outputTopic": "o"},
        {"name": "topology-inference", "enabled": "false", "outputTopic": "t"},
        {"name": "anomaly-detection", "enabled": "true", "outputTopic": "a"}]})
    assert [(u.name, u.output) for u in jobs.load_use_cases(text)] == [
        ("outage-intelligence", "o"), ("anomaly-detection", "a")]
    assert set(jobs.registry(None)) == {u.name for u in jobs.DEFAULT_USE_CASES}
    with pytest.raises(ValueError, match="nonsense"):
        jobs.start_use_cases(None, [jobs.UseCase("nonsense", True, "x")], None, None)
