"""The outage stream over several files: late rows, other orders, missing numbers, runs after runs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meterflow.operators.outage import CONTEXT, outage_incidents
from meterflow.sinks.tables import read_table
from meterflow.streaming import jobs

SCHEMA = ("msn string, event_tblrefid int, event_name string, event_state string, seq bigint, event_us bigint, "
          + ", ".join(f"{name} string" for name in CONTEXT if name != "event_name"))
MINUTE = 60_000_000
NOON = 1_704_110_400_000_000


def event(seq, minute, occurs, msn="k1", pair=1):
    return (msn, pair, "Power failure", "OCCURRENCE" if occurs else "RESTORATION", seq,
            NOON + int(minute * MINUTE), *["x"] * (len(CONTEXT) - 1))


def run(spark, tmp_path, files, number=0):
    """Drain the files, one per micro-batch in the given order, and finish; all files are read so far."""
    folder = tmp_path / "in"
    for place, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(folder))
    target = jobs.Target(str(tmp_path / "t"), str(tmp_path / "c"), available_now=True)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    jobs.start_outages(stream, target).awaitTermination()
    jobs.finish_outages(spark, target)
    return sorted(map(str, read_table(spark, "outage_incident_events", target.root).drop("received_at").collect()))


def batch(spark, files):
    rows = [row for rows in files for row in rows]
    return sorted(map(str, outage_incidents(spark.createDataFrame(rows, SCHEMA)).collect()))


def test_restoration_that_comes_late_still_closes(spark, tmp_path):
    """A restoration far behind the clock: the other meters have long gone on."""
    files = [[event(1, 0, True)], [event(2, 60, True, "k2")], [event(3, 120, True, "k3")],
             [event(4, 3, False)], [event(5, 130, False, "k3")]]
    got = run(spark, tmp_path, files)
    closed = [r for r in got if "CLOSED" in r]
    assert len(closed) == 2 and any("k1" in r and "duration_minutes=3.0" in r for r in closed)
    # Its alert had been given when it came; apart from that all is as in the batch form.
    assert [r for r in got if not ("k1" in r and "UNRESOLVED" in r)] == batch(spark, files)


@pytest.mark.parametrize("order", [None, 4, 9])
def test_files_in_any_order_within_the_hold(spark, tmp_path, order):
    chance, rows = random.Random(5), []
    for seq in range(240):
        msn = f"k{chance.randrange(6)}"
        # Within ten minutes in all; clocks are off by up to a minute.
        rows.append(event(seq, seq / 24 + chance.uniform(-1, 1), chance.random() < 0.5, msn))
    files = [rows[n: n + 40] for n in range(0, 240, 40)]
    want = batch(spark, files)
    if order:
        random.Random(order).shuffle(files)
    assert run(spark, tmp_path, files) == want


def test_next_run_goes_on_and_counts_nothing_twice(spark, tmp_path):
    first = [[event(1, 0, True), event(2, 1, True, "k2")], [event(3, 2, False, "k2"), event(4, 3, True, "k3")]]
    second = [[event(5, 4, False)], [event(6, 30, False, "k3"), event(7, 31, True, "k2")]]
    assert run(spark, tmp_path, first) == batch(spark, first)
    assert run(spark, tmp_path, second) == batch(spark, first + second)


def test_rows_without_a_number(spark, tmp_path):
    files = [[event(None, 0, True), event(None, 2, False), event(1, 0, True, "k2")], [event(None, 9, False, "k2")]]
    numbered = [[event(1, 0, True), event(2, 2, False), event(3, 0, True, "k2")], [event(4, 9, False, "k2")]]
    assert run(spark, tmp_path, files) == batch(spark, numbered)


def test_a_wrong_clock_holds_up_nobody(spark, tmp_path):
    files = [[event(1, 0, True)], [event(2, 10**9, True, "k2")], [event(3, 2, False)], [event(4, 40, True)],
             [event(5, 41, False)]]
    got = run(spark, tmp_path, files)
    assert len([r for r in got if "k1" in r and "CLOSED" in r]) == 2
    assert [r for r in got if "UNRESOLVED" not in r] == [r for r in batch(spark, files) if "UNRESOLVED" not in r]
