"""What the drained stream queries cost: row groups of a micro-batch's file, state calls of a key."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import Row

from meterflow.operators.outage import CONTEXT
from meterflow.plans import derive
from meterflow.streaming.outage_state import HOLD_MS, ClockedOutages, Machine


def test_a_micro_batch_file_can_be_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(derive, "ROW_GROUP_BYTES", 1 << 18)
    files = glob.glob(derive.event_files(spark, "/root/testdata/sf0.1", 2).removeprefix("file:") + "/*.parquet")
    assert len(files) == 2 and all(pq.ParquetFile(file).num_row_groups > 2 for file in files)


class Handle:
    """State of one key, counting the calls that would go to the JVM."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_a_key_makes_few_state_calls():
    made = Row("seq", "occurs", "event_us", *CONTEXT)
    handle, machine = Handle(), ClockedOutages(Machine(300_000), HOLD_MS)
    machine.init(handle)
    rows = [made(n, n % 2 == 0, n * 60_000_000, *["x"] * len(CONTEXT)) for n in range(40)]
    assert list(machine.handleInputRows(("k", 1), iter(rows), Clock(0))) == []
    assert handle.calls <= 3 and handle.timers == {HOLD_MS}
    handle.timers.clear()
    clock = Clock(HOLD_MS)
    first = list(machine.handleExpiredTimer(("k", 1), clock, clock))
    assert [r["incident_status"] for r in first] == ["OPEN"] and handle.calls <= 6
    end = max(handle.timers)
    got = list(machine.handleInputRows(("k", 1), iter([]), Clock(end + 10**9)))
    assert [r["incident_status"] for r in got].count("CLOSED") == 20
    assert handle.value is None and not handle.timers
