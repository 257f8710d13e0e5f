from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from meterflow.operators import outage, reliability

SCHEMA = (
    "msn string, event_tblrefid int, seq bigint, occurs boolean, event_us bigint, "
    "arrival_us bigint, event_name string, dtr_name string, dtr_network_code string, "
    "feeder_name string, substation_name string")
SECOND = 1_000_000
MINUTE = 60 * SECOND


def frame(spark, events):
    """Events as (msn, seq, occurs, micros)."""
    return spark.createDataFrame(
        [(msn, 1, seq, occurs, us, seq * MINUTE, "Power failure", f"D{seq}", None, "F", None)
         for msn, seq, occurs, us in events], SCHEMA)


def plain_machine(events, guard=True, whole=True):
    """The state machine, one key at a time in arrival order."""
    open_since, incidents = {}, []
    for msn, seq, occurs, us in sorted(events, key=lambda e: e[1]):
        if occurs:
            start = us // SECOND * SECOND if whole else us
            open_since.setdefault(msn, (start, seq))
        elif msn in open_since and (not guard or us >= open_since[msn][0]):
            incidents.append((msn, *open_since.pop(msn), us))
    return sorted(incidents + [(m, *since, None) for m, since in open_since.items()],
                  key=lambda i: (i[0], i[2]))


def paired(spark, events, **options):
    rows = outage.pair_incidents(frame(spark, events), **options).collect()
    for row in rows:
        assert row["dtr_name"] == f"D{row['start_seq']}"
    return sorted(((r["msn"], r["start_us"], r["start_seq"], r["end_us"]) for r in rows),
                  key=lambda i: (i[0], i[2]))


def random_events(seed, count, meters, disorder):
    rng = random.Random(seed)
    hot = "m0"
    return [(hot if rng.random() < 0.4 else f"m{rng.randrange(meters)}", seq,
             rng.random() < 0.5, (seq * 10 + rng.randrange(disorder)) * SECOND // 3)
            for seq in range(count)]


@pytest.mark.parametrize("chunk_rows", [1, 7, 50, 1 << 20])
@pytest.mark.parametrize("disorder", [1, 5000])
def test_pairing_equals_plain_machine(spark, chunk_rows, disorder):
    events = random_events(chunk_rows + disorder, 1500, 12, disorder)
    assert paired(spark, events, chunk_rows=chunk_rows) == plain_machine(events)


def test_service_pairing_has_no_guard(spark):
    events = random_events(3, 600, 5, 5000)
    got = paired(spark, events, chunk_rows=20, guard=False, whole_seconds=False)
    assert got == plain_machine(events, guard=False, whole=False)


def test_wrong_clock_in_the_future(spark):
    # An outage stamped far ahead is never closed; the state must survive every later chunk.
    events = [("a", 0, True, 10 ** 17)] + [
        ("a", i, i % 2 == 0, i * SECOND) for i in range(1, 60)]
    assert paired(spark, events, chunk_rows=5) == [("a", 10 ** 17, 0, None)]


def log(spark, events, unresolved="event"):
    rows = outage.incident_log(outage.pair_incidents(frame(spark, events)), unresolved)
    return rows, sorted((r["incident_status"], r["start_ts"], r["end_ts"], r["duration_minutes"])
                        for r in rows.collect())


def test_ordered_keys_never_reach_the_machine(spark, monkeypatch):
    def refuse(_):
        raise AssertionError("no key needs the state machine here")
    monkeypatch.setattr(outage, "_by_machine", refuse)
    rng = random.Random(5)
    events = [(f"m{rng.randrange(3)}", seq, rng.random() < 0.5, seq * SECOND) for seq in range(900)]
    for chunk_rows in (1, 10, 1 << 20):
        assert paired(spark, events, chunk_rows=chunk_rows) == plain_machine(events)


def test_fast_clock_takes_no_square_time(spark):
    """Occurrences stamped far ahead of all restorations, each later than the one before."""
    count = 100_000
    table, started = outage._Table(), time.time()
    for n in range(count // 2):
        table.occurs(outage.Opening(10 ** 12 + n, 2 * n, 0, *[None] * 5))
        table.restored(n)
    assert time.time() - started < 10
    pieces = table.pieces()
    assert pieces[0][1].start_us == 10 ** 12 and len(pieces) == count // 2 + 1
    events = [("a", 2 * n + k, k == 0, (n + (10 ** 6 if k == 0 else 0)) * SECOND)
              for n in range(1500) for k in (0, 1)]
    assert paired(spark, events, chunk_rows=400) == plain_machine(events)


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_previous_state_crosses_chunks(spark, chunk_rows):
    events = random_events(2, 200, 4, 10)
    got = {r["seq"]: r["previous_occurs"] for r in
           outage.previous_states(frame(spark, events), chunk_rows).collect()}
    last, want = {}, {}
    for msn, seq, occurs, _ in events:
        want[seq] = last.get(msn)
        last[msn] = occurs
    assert got == want


def test_arrival_alerts_need_the_arrival_column(spark):
    with pytest.raises(ValueError):
        outage.outage_incidents(spark.range(1), "arrival")


def test_log_edge_cases(spark):
    at = 1704103200 * SECOND  # 2024-01-01 10:00:00
    start = "2024-01-01 10:00:00"
    assert log(spark, [("a", 1, False, at)])[1] == []
    # The start is cut to the second, the end is not.
    rows, got = log(spark, [("a", 1, True, at + 900_000), ("a", 2, False, at + 500_000)])
    assert got == [("CLOSED", start, start, 500 / 60000), ("OPEN", start, None, None)]
    assert rows.first()["incident_id"] == "a:1:2024-01-01T10:00:00"
    # Repeats are ignored; a restoration before the start leaves the outage open.
    _, got = log(spark, [("a", 1, True, at), ("a", 2, True, at + MINUTE),
                         ("a", 3, False, at - MINUTE), ("a", 4, False, at + 2 * MINUTE)])
    assert got == [("CLOSED", start, "2024-01-01 10:02:00", 2.0), ("OPEN", start, None, None)]
    # Exactly five minutes is in time, more is not, and never is not.
    assert len(log(spark, [("a", 1, True, at), ("a", 2, False, at + 5 * MINUTE)])[1]) == 2
    _, got = log(spark, [("a", 1, True, at), ("a", 2, False, at + 6 * MINUTE)])
    assert [g[0] for g in got] == ["CLOSED", "OPEN", "UNRESOLVED"] and got[2][2:] == (None, 5.0)
    assert [g[0] for g in log(spark, [("a", 1, True, at)])[1]] == ["OPEN", "UNRESOLVED"]
    assert [g[0] for g in log(spark, [("a", 1, True, at)], None)[1]] == ["OPEN"]
    # By arrival the same pair took one minute.
    assert [g[0] for g in log(
        spark, [("a", 1, True, at), ("a", 2, False, at + 6 * MINUTE)], "arrival")[1]] == [
            "CLOSED", "OPEN"]


def test_service_rounds_to_two_digits(spark):
    rows = outage.service_incident_log(outage.pair_incidents(
        frame(spark, [("a", 1, True, 500_000), ("a", 2, False, 100_000)]),
        guard=False, whole_seconds=False))
    closed = rows.where("incident_status = 'CLOSED'").first()
    assert closed["incident_id"] == "a:1:1970-01-01T00:00:00.500000"
    assert closed["duration_minutes"] == -0.01


def test_reliability(spark):
    events = [("a", 1, True, 0), ("a", 2, False, MINUTE), ("a", 3, True, 2 * MINUTE),
              ("a", 4, False, 12 * MINUTE), ("b", 5, True, 0)]
    rows, _ = log(spark, events)
    latest = {r["incident_id"][:1] + r["start_ts"][14:16]: r["incident_status"]
              for r in reliability.latest_per_incident(rows).collect()}
    assert latest == {"a00": "CLOSED", "a02": "CLOSED", "b00": "UNRESOLVED"}
    assert [r["msn"] for r in reliability.active_incidents(rows).collect()] == ["b"]
    counts = {(r["level"], r["name"]): r["outages"]
              for r in reliability.outage_frequency(rows).collect()}
    assert counts["meter", "a"] == 2 and counts["day", "1970-01-01"] == 3
    activity = {r["name"]: r for r in reliability.restoration_activity(rows)
                .where("level = 'feeder'").collect()}
    assert (activity["F"]["opened"], activity["F"]["closed"]) == (3, 2)
    duration = reliability.outage_duration(rows).where("level = 'meter'").first()
    assert (duration["total_minutes"], duration["median_minutes"]) == (11.0, 5.5)
    depths = [r["depth"] for r in reliability.network_rollup(rows).collect()]
    assert sorted(depths) == [0, 1, 2, 3, 3]


def test_rejects(spark):
    rows = spark.createDataFrame(
        [(0, None, 1, "Power failure", 5), (1, "a", None, "Power failure", 5),
         (2, "a", 1, "Power failure", None), (3, "a", 1, "Power failure", 5),
         (4, "a", 1, "power failure", 5)],
        "seq bigint, msn string, event_tblrefid int, event_name string, event_us bigint")
    got = {r["seq"]: r["reject_reason"] for r in outage.service_rejects(rows).collect()}
    assert got == {0: "MISSING_MSN", 1: "MISSING_PAIR_ID", 2: "INVALID_TIMESTAMP", 3: None}
