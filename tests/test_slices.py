"""Keys of a slice share their state calls, and keep apart what is theirs."""

from __future__ import annotations

import json

from pyspark.sql import Row

from meterflow.operators.outage import CONTEXT
from meterflow.streaming.outage_state import HOLD_MS, ClockedOutages, Machine
from test_stream_work import Clock, Handle

MINUTE = 60_000_000


def text(msn, seq, occurs, minute):
    return Row(slice=0, row=json.dumps([msn, "1", str(seq), str(int(occurs)), str(minute * MINUTE), *["x"] * len(CONTEXT)]))


def test_keys_of_a_slice_share_state_calls():
    """Two hundred keys made two hundred times the calls of one."""
    handle, machine = Handle(), ClockedOutages(Machine(300_000), HOLD_MS, sliced=True)
    machine.init(handle)
    rows = [text(f"k{n}", n, True, n) for n in range(200)] + [text("k7", 200, False, 9)]
    assert list(machine.handleInputRows((0,), iter(rows), Clock(0))) == []
    assert handle.calls <= 3 and handle.timers == {HOLD_MS}
    # k7 is closed when the clock has passed its restoration; nobody's alert is due before the first.
    handle.timers.clear()
    clock = Clock(HOLD_MS + 9 * 60_000)
    given = [r for t in machine.handleExpiredTimer((0,), clock, clock) for r in json.loads(t["records"])]
    assert sorted(r[0] for r in given if r[2] == "OPEN") == sorted(f"k{n}" for n in range(10))
    assert [r[0] for r in given if r[2] == "CLOSED"] == ["k7"]
    assert sorted(r[0] for r in given if r[2] == "UNRESOLVED") == ["k0", "k1", "k2", "k3", "k4"]
    # Untouched keys go on as they were; k199 is closed before its alert is due.
    end = Clock(10**9)
    given = [r for t in machine.handleInputRows((0,), iter([text("k199", 300, False, 200)]), end)
             for r in json.loads(t["records"])]
    assert sum(r[2] == "OPEN" for r in given) == 190
    assert sum(r[2] == "UNRESOLVED" for r in given) == 200 - 2 - 5
    assert handle.calls <= 12
