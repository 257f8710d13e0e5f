from __future__ import annotations

import json

from pyspark.sql import functions as F

from meterflow.operators import enrich, features, parse, project, replay
from meterflow.schemas import PROCESSED_EVENT, column_names

CATALOGUE = [(0, 7, 9, "Old", "OCCURRENCE"), (1, 7, 1, "Power failure", "OCCURRENCE"),
             (2, 8, 1, "Power failure", "RESTORATION"), (3, 0, 5, "Zero", "OCCURRENCE")]


def messages(spark, *documents):
    rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "seq bigint, payload string")


def catalogue(spark):
    rows = spark.createDataFrame(
        CATALOGUE, "ordinal int, event_id int, event_tblrefid int, event_name string, "
        "event_state string")
    return rows.withColumns({
        "isrestoration": F.col("event_state") == "RESTORATION", "priorityname": F.lit("High"),
        "eventclassification_name": F.lit("Supply"), "event_description": F.lit("d")})


def hierarchy(spark):
    return spark.createDataFrame(
        [(0, "ABC", "D0", "C0", "F0", "S0"), (1, " abc ", "D1", "C1", " F1 ", ""),
         (2, "  ", "D2", "C2", "F2", "S2")],
        "ordinal int, msn_normalized string, dtr_name string, dtr_network_code string, "
        "feeder_name string, substation_name string")


def enriched(spark, *documents):
    return enrich.enrich(
        parse.validate(parse.parse_events(messages(spark, *documents))), catalogue(spark),
        hierarchy(spark))


def by_seq(rows):
    return {row["seq"]: row for row in rows.collect()}


def test_parse_keeps_json_types_apart(spark):
    rows = by_seq(parse.parse_events(messages(
        spark,
        {"msn": 12, "evnt_id": "7", "v_r": "230.1", "v_y": 230.25, "latitude": "28.5"},
        {"evnt_id": 7.9, "v_r": None, "v_y": "x", "latitude": "north"},
        {"evnt_id": "x", "msn_id": "7.9"},
        "[1,2]", '"text"', "{bad", "", '{"v_r": NaN}')))
    assert sorted(rows) == [0, 1, 2]
    assert (rows[0]["msn"], rows[0]["evnt_id"], rows[0]["latitude"]) == ("12", 7, 28.5)
    assert (rows[0]["v_r"], rows[0]["v_r_num"]) == (230.1, None)
    assert (rows[0]["v_y"], rows[0]["v_y_num"]) == (230.25, 230.25)
    assert (rows[1]["evnt_id"], rows[1]["v_r"], rows[1]["v_y"]) == (7, None, 0.0)
    assert rows[1]["latitude"] is None
    assert (rows[2]["evnt_id"], rows[2]["msn_id"]) == (0, 7)


def test_quarantine_takes_what_parse_leaves(spark):
    rows = by_seq(parse.quarantine(messages(spark, {"msn": "a"}, "[1]", "{bad", '"s"')))
    assert {seq: row["reject_reason"] for seq, row in rows.items()} == {
        1: "NOT_AN_OBJECT", 2: "MALFORMED", 3: "NOT_AN_OBJECT"}


def test_parse_reads_the_payload_once(spark):
    rows = parse.validate(parse.parse_events(messages(spark, {"msn": "a"})))
    plan = features.eligible(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_blank_ids_are_flagged_not_dropped(spark):
    rows = by_seq(parse.validate(parse.parse_events(messages(
        spark, {"msn": None}, {"msn": ""}, {"msn": "  "}, {"msn": "\t"}, {"msn": " a "}, {}))))
    assert [rows[i]["validation_status"] for i in range(6)] == ["INVALID"] * 4 + ["VALID", "INVALID"]
    assert rows[0]["validation_reason"] == "MSN is null or blank"
    sql = by_seq(parse.validate_sql(parse.parse_events_sql(messages(
        spark, {"msn": " "}, {"msn": "\t"}, "{bad"))))
    assert [sql[i]["validation_status"] for i in range(3)] == ["FAIL", "PASS", "FAIL"]
    assert sql[0]["validation_reason"] == "MISSING_MSN"


def test_lookups_last_duplicate_wins_and_flags(spark):
    rows = by_seq(enriched(
        spark, {"msn": " abc", "evnt_id": 7}, {"msn": "zzz", "evnt_id": 99}, {"evnt_id": None},
        {"msn": "ABC", "evnt_id": "junk"}))
    assert len(rows) == 4
    assert rows[0]["event_name"] == "Power failure" and rows[0]["event_catalogue_match"]
    assert (rows[0]["msn_normalized"], rows[0]["feeder_name"]) == ("ABC", "F1")
    assert rows[0]["substation_name"] is None
    assert not rows[1]["hierarchy_match"] and rows[1]["msn_normalized"] is None
    assert not rows[2]["event_catalogue_match"] and rows[2]["event_name"] is None
    assert rows[3]["event_name"] == "Zero"  # unreadable ids count as 0


def test_large_lookup_is_not_broadcast(spark, monkeypatch):
    from meterflow.operators import skew

    monkeypatch.setattr(skew, "fits_broadcast", lambda source: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = enriched(spark, {"msn": "abc", "evnt_id": 7}, {"msn": None, "evnt_id": 1})
        assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
        found = by_seq(rows)
        assert found[0]["hierarchy_match"] and not found[1]["hierarchy_match"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fits_broadcast_measures_rows_and_width(spark):
    from meterflow.operators.skew import fits_broadcast

    rows = spark.range(100).withColumn("text", F.lit("x" * 50))
    assert fits_broadcast(rows)
    assert not fits_broadcast(rows, max_rows=99)
    assert not fits_broadcast(rows, max_bytes=1000)


def test_processed_projection_is_closed(spark):
    rows = project.processed_events(enriched(spark, {"msn": "abc", "ts": "t", "other": 1}))
    assert rows.columns == column_names(PROCESSED_EVENT)
    assert rows.first()["event_ts"] == "t"
    value = json.loads(project.as_json(rows).first()["value"])
    assert value["event_ts"] == "t" and value["v_r"] is None


def test_features(spark):
    ts = "2024-01-01 10:0%d:00"
    rows = features.meter_features(enriched(
        spark,
        {"msn": " a ", "ts": ts % 1, "v_r": 230, "v_y": 231.0, "evnt_id": 7},
        {"msn": "a", "ts": " " + ts % 2 + ".5 ", "v_r": "999", "v_b": 236},
        {"msn": "A", "ts": ts % 3},
        {"msn": "a", "ts": "bad", "v_r": 1}, {"msn": " ", "ts": ts % 4, "v_r": 1},
        {"msn": "a", "ts": "2024-01-01 10:15:00", "v_r": 229}))
    found = {(r["msn"], str(r["window_start"])[11:16]): r for r in rows.collect()}
    assert len(found) == 3
    row = found["a", "10:00"]
    assert row["event_count_15m"] == 2 and row["power_failure_count_15m"] == 1
    assert row["avg_voltage_15m"] == (230 + 231 + 236) / 3 and row["voltage_range_15m"] == 6
    empty = found["A", "10:00"]
    assert empty["avg_voltage_15m"] is None and empty["voltage_range_15m"] is None
    assert found["a", "10:15"]["event_count_15m"] == 1


def test_replay_time_modes(spark):
    events = parse.parse_events(messages(
        spark, {"dt": "202401011005", "ts": "2024-01-01 10:00:00"}, {"ts": "2024-01-01 10:01:00"}))
    order = lambda mode: [r["seq"] for r in replay.replay_order(events, mode).collect()]
    assert order("auto") == [1, 0] and order("ts") == [0, 1] and order("dt") == [0, 1]
    stamp = replay.stamp_replayed(events).first()["replayed_at"]
    assert stamp.endswith("+00:00") and len(stamp) == 29
