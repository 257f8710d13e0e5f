"""Reliability summaries kept per micro-batch equal those of the whole log."""

from __future__ import annotations

import random

import pytest

from meterflow.operators import reliability
from meterflow.streaming import jobs
from meterflow.streaming.reliability_state import INCIDENTS, ReliabilityTables, pieces
from tests.test_outage_stream import SCHEMA, event


def test_pieces_cover_all_batches_once():
    for fan in (2, 3, 16):
        for batches in range(200):
            found = pieces(batches, fan)
            held = sorted(n for level, first, end in found for n in range(first * fan ** level, end * fan ** level))
            assert held == list(range(batches))
            assert all(end - first < fan for _, first, end in found)


def incidents(n, seed):
    """Rows of a log: some outages open, some with an alert, some closed; a missing name now and then."""
    chance, rows = random.Random(seed), []
    for i in range(n):
        place = (chance.choice(["d1", "d2", None]), "c", chance.choice(["f1", "f2"]), chance.choice(["s1", None]))
        start = f"2024-01-0{chance.randrange(1, 4)} 00:00:{i:02d}"
        ids = (f"k{i}:1:{start}", f"k{i % 7}", "Power failure", 1)
        rows.append((*ids, "OPEN", start, None, None, *place))
        if chance.random() < 0.4:
            rows.append((*ids, "UNRESOLVED", start, None, 5.0, *place))
        if chance.random() < 0.6:
            rows.append((*ids, "CLOSED", start, start, round(chance.uniform(0, 90), 3), *place))
    return rows


def as_text(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


@pytest.mark.parametrize("fan", [2, 3])
def test_any_split_into_batches(spark, tmp_path, fan):
    rows = incidents(40, 3)
    log = spark.createDataFrame(rows, INCIDENTS)
    tables = ReliabilityTables(str(tmp_path / "r"), fan)
    tables.prepare(spark)
    assert tables.read(spark, "levels").isEmpty()
    chance, split = random.Random(fan), {}
    for row in rows[:-5]:
        split.setdefault(chance.choice([0, 1, 2, 4, 5, 7, 8]), []).append(row)
    for batch_id in range(9):  # 3 and 6 are empty
        part = spark.createDataFrame(split.get(batch_id, []), INCIDENTS)
        tables.update(part, batch_id)
        if batch_id in (3, 7):  # as after a failure before the commit
            tables.update(part, batch_id)
    # What an earlier finished run owed is taken back.
    tables.owe(spark.createDataFrame(rows[:9], INCIDENTS))
    tables.owe(spark.createDataFrame(rows[-5:], INCIDENTS))
    assert as_text(reliability.rollup_of(tables.read(spark, "network"))) == as_text(reliability.network_rollup(log))
    assert as_text(tables.read(spark, "status")) == as_text(reliability.latest_per_incident(log))
    reports = reliability.reports_of(tables.read(spark, "levels"))
    activity = reliability.restoration_activity(log)
    assert as_text(reports.select(*activity.columns)) == as_text(activity)
    frequency = reliability.outage_frequency(log)
    assert as_text(reports.selectExpr("level", "name", "opened as outages")) == as_text(frequency)
    duration = reliability.outage_duration(log).drop("median_minutes")
    assert as_text(reports.where("closed > 0").select(*duration.columns)) == as_text(duration)


def test_summaries_go_on_in_the_next_run(spark, tmp_path):
    """Owed records of a finished run count once, also after the next run."""
    folder, target = tmp_path / "in", jobs.Target(str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    for rows in ([event(1, 0, True), event(2, 1, True, "k2")], [event(3, 4, False), event(4, 40, True, "k3")]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(folder))
        stream = spark.readStream.schema(SCHEMA).json(str(folder))
        jobs.start_reliability(stream, target, fan=2).awaitTermination()
        jobs.finish_reliability(spark, target)
    got = {r.incident_id.split(":")[0]: r.incident_status
           for r in jobs.reliability_summary(spark, target, "status", fan=2).collect()}
    assert got == {"k1": "CLOSED", "k2": "UNRESOLVED", "k3": "UNRESOLVED"}
    total = jobs.reliability_summary(spark, target, "levels", fan=2).where("level = 'meter'").selectExpr(
        "sum(opened)", "sum(unresolved)", "sum(closed)").first()
    assert tuple(total) == (3, 2, 1)
