"""The outage state machine on a stream: a reorder buffer per key, alerts by the stream's clock.

The clock is the largest event time any row has shown. A row waits in its key's buffer until the
clock has passed its event time by ``HOLD``, so that rows whose files came in another order are applied
in order of arrival number. No row is late: the watermark is set so far back that it filters
nothing, and rows that come behind the clock are applied when they come. A drained run ends with what
still waits; ``finish`` applies that to the open outages and writes it beside the table's batches.
"""

from __future__ import annotations

import json
from collections import namedtuple
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.functions import minutes_between, seconds_text
from meterflow.operators.outage import (
    CONTEXT, INCIDENT_COLUMNS, UNRESOLVED_AFTER_US, outage_rows, service_records, service_rows,
)

HOLD_MS = 15 * 60 * 1000
# Keys share their state in so many slices; records leave Python so many to a text.
SLICES, TEXT_RECORDS = 1024, 1024
# Event times are moved ahead and the watermark back by four thousand years: it equals the largest
# event time, and no row is behind it. The clock stops at the year 3000, so that a wrong one keeps to this.
FAR_DAYS = 4000 * 365
FAR = f"{FAR_DAYS} days"
LAST_CLOCK_US = 1030 * 365 * 86_400_000_000

_CONTEXT_TYPES = ", ".join(f"{name} string" for name in CONTEXT)
_WAITING = f"seq bigint, occurs boolean, event_us bigint, {_CONTEXT_TYPES}, ready_ms bigint"
_KEPT = "kept string"
_KEYS = "msn string, event_tblrefid int"
_EMITTED = f"{_KEYS}, incident_status string, start_us bigint, end_us bigint, {_CONTEXT_TYPES}"
_TEXTS = "records string"
_Emitted = Row(*[part.split()[0] for part in _EMITTED.split(", ")])
_Waiting = namedtuple("_Waiting", [part.split()[0] for part in _WAITING.split(", ")])


class Machine:
    """Open, alert, close: the transitions of one key, on a stream and when a run is finished.

    The open outage is a tuple ``(start_us, *context, alert_ms)``; ``alert_ms`` is when its alert is due on
    the clock in use, None once it has been given or if there are no alerts. ``guard`` and ``whole_seconds``
    are those of the batch form.
    """

    def __init__(self, alert_after_ms: int | None, guard: bool = True, whole_seconds: bool = True) -> None:
        self.alert_after_ms, self.guard, self.whole_seconds = alert_after_ms, guard, whole_seconds

    @staticmethod
    def emit(key: tuple, status: str, state: tuple, end_us: int | None = None) -> Row:
        return _Emitted(*key, status, state[0], end_us, *state[1:-1])

    def apply(
        self, key: tuple, state: tuple | None, rows: Iterable[Any], wall_ms: int | None = None,
    ) -> tuple[tuple | None, list[Row]]:
        """The state after the rows, and the records they give. ``wall_ms`` starts alerts by wall clock."""
        out = []
        for row in rows:
            if row.occurs:
                if state is None:
                    start, alert = row.event_us, None
                    if self.whole_seconds:
                        start = start // 1_000_000 * 1_000_000
                    if self.alert_after_ms is not None:
                        alert = (start // 1000 if wall_ms is None else wall_ms) + self.alert_after_ms
                    state = (start, *[getattr(row, name) for name in CONTEXT], alert)
                    out.append(self.emit(key, "OPEN", state))
            elif state is not None and (not self.guard or row.event_us >= state[0]):
                if wall_ms is None and state[-1] is not None and (
                        row.event_us > state[0] + self.alert_after_ms * 1000):
                    out.append(self.emit(key, "UNRESOLVED", state))
                out.append(self.emit(key, "CLOSED", state, row.event_us))
                state = None
        return state, out


def in_order(row: Any) -> tuple:
    """Arrival order; rows without a number come behind the others, by event time."""
    return row.seq is None, row.seq or 0, row.event_us


def _picked(rows: Iterable[Row]) -> Iterator[tuple]:
    """The columns that a waiting row keeps, by place: looking each up by name costs more than the machine."""
    pick = None
    for row in rows:
        if pick is None:
            pick = itemgetter(*[row.__fields__.index(name) for name in _Waiting._fields[:-1]])
        yield pick(row)


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """Rows as ``slice`` and one JSON text: handing a row to Python costs by its columns."""
    columns = [*(part.split()[0] for part in _KEYS.split(", ")), *_Waiting._fields[:-1]]
    texts = [F.col(name).cast("int" if name == "occurs" else "string").cast("string") for name in columns]
    return rows.withColumns({
        "slice": F.pmod(F.xxhash64("msn", "event_tblrefid"), F.lit(slices)).cast("int"),
        "row": F.to_json(F.array(*texts))})


def _unsliced(emitted: DataFrame) -> DataFrame:
    """The records of texts that ``KeptOutages`` gave for slices."""
    record = F.explode(F.from_json("records", "array<array<string>>"))
    fields = [part.split() for part in _EMITTED.split(", ")]
    return emitted.select(record.alias("record")).select(
        *[F.get("record", F.lit(n)).cast(kind).alias(name) for n, (name, kind) in enumerate(fields)])


class KeptOutages(StatefulProcessor):
    """Open outages and waiting rows of a group: of one (meter, event pair), or of a slice of all.

    Each state call is a round trip to the JVM, which costs more than the machine, so the keys of a slice
    share one value: a JSON text ``[timer, [[msn, event pair, due, open outage, waiting rows], ...]]``. ``due`` is when
    a key has to be looked at without new rows. The rows of a slice's keys of one micro-batch, and what
    its keys keep, are held at once.
    """

    def __init__(self, machine: Machine, sliced: bool) -> None:
        self.machine, self.sliced = machine, sliced

    def now(self, timer_values: Any) -> int | None:
        """The clock that timers go by."""
        raise NotImplementedError

    def step(
        self, key: tuple, state: tuple | None, held: list, arrived: list[tuple], now: int | None,
    ) -> tuple[int | None, tuple | None, list, list[Row]]:
        """``due``, the open outage and the waiting rows of a key after the rows, and the records they give."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = {}
        if self.sliced:
            for row in rows:
                msn, pair, seq, occurs, event_us, *context = json.loads(row["row"])
                arrived.setdefault((msn, int(pair)), []).append(
                    (None if seq is None else int(seq), occurs == "1", int(event_us), *context))
        else:
            arrived[key] = list(_picked(rows))
        yield from self._turn(arrived, self.now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._turn({}, self.now(timerValues), expiredTimerInfo.getExpiryTimeInMs())

    def _turn(self, arrived: dict[tuple, list], now: int | None, expired: int | None = None) -> Iterator[Row]:
        """Apply what has come to its keys, look at those that are due, set the next timer."""
        before = self.kept.get()
        timer, kept = _loaded(before)
        if timer == expired:
            timer = None
        out = []
        for key in [*(k for k in kept if k not in arrived), *arrived]:
            due, state, held = kept.get(key, (None, None, []))
            if key in arrived or (due is not None and due <= now):
                *kept[key], records = self.step(
                    key, tuple(state) if state is not None else None, list(map(_Waiting._make, held)),
                    arrived.get(key, []), now)
                out += records
                if kept[key][1] is None and not kept[key][2]:
                    del kept[key]
        at = min((due for due, _, _ in kept.values() if due is not None), default=None)
        if timer != at:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if at is not None:
                self.handle.registerTimer(at)
        if kept:
            self.kept.update((json.dumps([at, [(*key, *value) for key, value in kept.items()]]),))
        elif before is not None:
            self.kept.clear()
        if not self.sliced:
            yield from out
            return
        for first in range(0, len(out), TEXT_RECORDS):
            yield Row(records=json.dumps(out[first: first + TEXT_RECORDS]))

    def close(self) -> None:
        pass


def _loaded(kept: tuple | None) -> tuple[int | None, dict[tuple, list]]:
    """Timer, and per key ``[due, open outage, waiting rows]``."""
    if kept is None:
        return None, {}
    timer, keys = json.loads(kept[0])
    return timer, {(msn, pair): value for msn, pair, *value in keys}


class ClockedOutages(KeptOutages):
    """Rows wait ``hold_ms`` by the stream's clock to be put in order, and alerts are given by that clock."""

    def __init__(self, machine: Machine, hold_ms: int, sliced: bool = False) -> None:
        super().__init__(machine, sliced)
        self.hold_ms = hold_ms

    def now(self, timer_values):
        return timer_values.getCurrentWatermarkInMs()

    def step(self, key, state, held, arrived, now):
        for row in arrived:
            # A clock that runs ahead of the stream's holds its key up for twice the time at most.
            at = row[2] // 1000
            ready = (min(at, now + self.hold_ms) if now > 0 else at) + self.hold_ms
            held.append(_Waiting(*row, ready))
        held.sort(key=in_order)
        done = next((n for n, row in enumerate(held) if row.ready_ms > now), len(held))
        state, out = self.machine.apply(key, state, held[:done])
        if state is not None and state[-1] is not None and state[-1] + self.hold_ms <= now:
            out.append(Machine.emit(key, "UNRESOLVED", state))
            state = (*state[:-1], None)
        due = [row.ready_ms for row in held[done: done + 1]]
        if state is not None and state[-1] is not None:
            due.append(state[-1] + self.hold_ms)
        return min(due, default=None), state, held[done:], out


class WallClockOutages(KeptOutages):
    """Alerts count wall-clock time from the processing of the occurrence. Rows are applied as they
    arrive, those of a micro-batch in order of their number."""

    def now(self, timer_values):
        return None if self.machine.alert_after_ms is None else timer_values.getCurrentProcessingTimeInMs()

    def step(self, key, state, held, arrived, now):
        state, out = self.machine.apply(
            key, state, sorted((_Waiting(*row, None) for row in arrived), key=in_order), now)
        if state is not None and state[-1] is not None and state[-1] <= now:
            out.append(Machine.emit(key, "UNRESOLVED", state))
            state = (*state[:-1], None)
        return state and state[-1], state, [], out


def _records(emitted: DataFrame, alert_after_us: int | None) -> DataFrame:
    status = F.col("incident_status")
    incident_id = F.concat_ws(
        ":", "msn", F.col("event_tblrefid").cast("string"),
        seconds_text(F.col("start_us"), "yyyy-MM-dd'T'HH:mm:ss"))
    return emitted.withColumns({
        "incident_id": incident_id, "start_ts": seconds_text(F.col("start_us")),
        "end_ts": seconds_text(F.col("end_us")),
        "duration_minutes": F.when(status == "CLOSED", minutes_between(
            F.col("start_us"), F.col("end_us")))
        .when(status == "UNRESOLVED", F.lit((alert_after_us or 0) / 60e6)),
    }).select(*INCIDENT_COLUMNS)


def outage_stream(
    enriched: DataFrame, alert_after_us: int | None = UNRESOLVED_AFTER_US,
    wall_clock: bool = False, hold_ms: int = HOLD_MS, slices: int = SLICES,
) -> DataFrame:
    """Enriched stream to incident records, emitted as they happen.

    By the stream's clock, rows wait ``hold_ms`` to be put in order, and an outage whose restoration has
    not come ``hold_ms`` after its alert was due is UNRESOLVED. By ``wall_clock`` rows are applied as
    they arrive, and alerts count wall-clock time from the processing of the occurrence; a query
    with such timers never ends by itself, since it waits for them. None keeps no alerts. A checkpoint
    goes on with the ``slices`` it was begun with.
    """
    machine = Machine(None if alert_after_us is None else alert_after_us // 1000)
    rows = _sliced(outage_rows(enriched), slices)
    if wall_clock:
        mode = "None" if alert_after_us is None else "ProcessingTime"
        emitted = rows.select("slice", "row").groupBy("slice").transformWithState(
            WallClockOutages(machine, sliced=True), _TEXTS, "Append", mode)
    else:
        emitted = rows.select("slice", "row", F.timestamp_micros(
            F.least("event_us", F.lit(LAST_CLOCK_US)) + FAR_DAYS * 86_400_000_000).alias("event_time")
        ).withWatermark("event_time", FAR).select("slice", "row").groupBy("slice").transformWithState(
            ClockedOutages(machine, hold_ms, sliced=True), _TEXTS, "Append", "EventTime")
    return _records(_unsliced(emitted), alert_after_us)


def finish(
    spark: SparkSession, checkpoint: str, alert_after_us: int | None = UNRESOLVED_AFTER_US,
) -> DataFrame:
    """The records that a drained run's state still owes, as if no row were to follow.

    Rows that wait are applied to the open outages; what is open then has its alert, as in the batch
    form. The state is only read: the next run goes on from it.
    """
    kept = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "kept").load()
    machine = Machine(None if alert_after_us is None else alert_after_us // 1000)

    def owed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text in rows["kept"]:
                for key, (_, state, held) in _loaded((text,))[1].items():
                    last, given = machine.apply(
                        key, tuple(state) if state is not None else None,
                        sorted(map(_Waiting._make, held), key=in_order))
                    out += given
                    if last is not None and last[-1] is not None:
                        out.append(Machine.emit(key, "UNRESOLVED", last))
            yield pd.DataFrame([tuple(r) for r in out], columns=list(_Emitted), dtype=object)

    emitted = kept.select("value.kept").mapInPandas(owed, _EMITTED)
    return _records(emitted, alert_after_us)


def service_stream(enriched: DataFrame) -> DataFrame:
    """The service variant: no guard, no alerts, fractions of seconds kept; rows as they arrive."""
    machine = Machine(None, guard=False, whole_seconds=False)
    emitted = _sliced(service_rows(enriched), SLICES).select("slice", "row").groupBy("slice").transformWithState(
        WallClockOutages(machine, sliced=True), _TEXTS, "Append", "None")
    return service_records(_unsliced(emitted)).select(*INCIDENT_COLUMNS)
