"""Outage incidents: an occurrence paired with the first restoration that can close it.

Per (meter, event pair), in arrival order: an occurrence opens an outage unless one is open; a
restoration closes the open outage unless it lies before its start. As long as no restoration
does, occurrences and restorations take turns: the first row of each run of occurrences pairs
with the first row of the next run of restorations. That is ``lag`` and ``lead``, windowed by chunks of
arrival order so that a hot key spreads over tasks, with one summary row per chunk for its neighbours.

Only keys where a restoration lies before the start it follows need the state machine, since there the
outcome of a row depends on everything before it. For them three passes follow:

1. ``_summarise``: each chunk becomes a small table "state before -> state after";
2. ``_carry``: per key, those tables are chained to give the state before each chunk;
3. ``_replay``: each chunk runs once more from its true starting state and emits its incidents.

Rows are sorted inside partitions and streamed, so no pass holds a group in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterflow.functions import (
    blank_to_null, control_trim, event_us, is_blank, micros_text, minutes_between, same_text,
    seconds_text,
)
from meterflow.operators.skew import materialise

POWER_FAILURE = "Power failure"
OCCURRENCE, RESTORATION = "OCCURRENCE", "RESTORATION"
UNRESOLVED_AFTER_US = 5 * 60 * 1_000_000
CHUNK_ROWS = 1 << 20

CONTEXT = ["event_name", "dtr_name", "dtr_network_code", "feeder_name", "substation_name"]
_OPENING = ["start_us", "start_seq", "start_arrival_us", *CONTEXT]
_OPENING_TYPES = "start_us bigint, start_seq bigint, start_arrival_us bigint, " + ", ".join(
    f"{name} string" for name in CONTEXT)
_KEY_TYPES = "msn string, event_tblrefid int"
_PIECE = f"struct<upto: bigint, is_open: boolean, {_OPENING_TYPES.replace(' ', ': ').replace(',: ', ', ')}>"

_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


class Opening(NamedTuple):
    """An open outage: when and in which row it started, and where."""

    start_us: int
    start_seq: int
    start_arrival_us: int
    event_name: str | None
    dtr_name: str | None
    dtr_network_code: str | None
    feeder_name: str | None
    substation_name: str | None


# ---- relevance -------------------------------------------------------------------------------

def outage_rows(enriched: DataFrame, arrival_us: Column | None = None) -> DataFrame:
    """Power-failure rows with all required fields, as the pairing passes take them."""
    state = control_trim(F.col("event_state"))
    kept = enriched.where(
        same_text(control_trim(F.col("event_name")), POWER_FAILURE)
        & (same_text(state, OCCURRENCE) | same_text(state, RESTORATION))
        & ~is_blank(F.col("msn")) & F.col("event_tblrefid").isNotNull()
        & F.col("event_us").isNotNull())
    arrival = F.col("event_us") if arrival_us is None else arrival_us
    return kept.select(
        control_trim(F.col("msn")).alias("msn"), F.col("event_tblrefid").cast("int"), "seq",
        same_text(state, OCCURRENCE).alias("occurs"), "event_us", arrival.alias("arrival_us"),
        *[blank_to_null(F.col(name)).alias(name) for name in CONTEXT])


def service_rejects(enriched: DataFrame, names: tuple[str, ...] = (POWER_FAILURE,)) -> DataFrame:
    """Outage rows of the service variant with the reason a row is skipped, null if it counts."""
    return enriched.where(F.col("event_name").isin(*names)).withColumn(
        "reject_reason",
        F.when(is_blank(F.col("msn")), "MISSING_MSN")
        .when(F.col("event_tblrefid").isNull(), "MISSING_PAIR_ID")
        .when(F.col("event_us").isNull(), "INVALID_TIMESTAMP"))


def service_rows(enriched: DataFrame, names: tuple[str, ...] = (POWER_FAILURE,)) -> DataFrame:
    """The service variant: exact-case words and upper-cased meter ids."""
    kept = service_rejects(enriched, names).where(
        F.col("reject_reason").isNull() & F.col("event_state").isin(OCCURRENCE, RESTORATION))
    return kept.select(
        F.upper(control_trim(F.col("msn"))).alias("msn"), F.col("event_tblrefid").cast("int"),
        "seq", (F.col("event_state") == OCCURRENCE).alias("occurs"), "event_us",
        F.col("event_us").alias("arrival_us"), *CONTEXT)


# ---- the three passes ------------------------------------------------------------------------

def _tuples(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*[batch.column(name).to_pylist() for name in names])


def _rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(columns, schema)],
        schema=schema)


_OPENING_FIELDS = [pa.field("start_us", pa.int64()), pa.field("start_seq", pa.int64()),
                   pa.field("start_arrival_us", pa.int64()),
                   *[pa.field(name, pa.string()) for name in CONTEXT]]
_KEY_FIELDS = [pa.field("msn", pa.string()), pa.field("event_tblrefid", pa.int32())]
_PIECE_TYPE = pa.struct([pa.field("upto", pa.int64()), pa.field("is_open", pa.bool_()),
                         *_OPENING_FIELDS])


class _Table:
    """A chunk as a function: the state after it, by the state before it.

    Entries are told apart by the start of the outage that is open before the chunk: a piece
    ``upto`` stands for starts after the piece before it and up to ``upto``, the lowest for
    starting closed. An outage open since later than every ``upto`` is still open. Entries that
    have come to the same state stay together, so a row costs the logarithm of the open states.
    """

    def __init__(self) -> None:
        self.reach = _LOWEST
        self.closed: list[int] = [_LOWEST]
        self.open: list[tuple[int, int, Opening, list[int]]] = []
        self.steps = 0

    def occurs(self, opening: Opening) -> None:
        if self.closed:
            self.steps += 1
            heappush(self.open, (opening.start_us, self.steps, opening, self.closed))
            self.closed = []

    def restored(self, ends_us: int) -> None:
        while self.open and self.open[0][0] <= ends_us:
            entries = heappop(self.open)[3]
            if len(entries) > len(self.closed):
                entries, self.closed = self.closed, entries
            self.closed += entries
        if ends_us > self.reach:
            self.closed.append(ends_us)
            self.reach = ends_us

    def pieces(self) -> list[tuple[int, Opening | None]]:
        states = [(upto, None) for upto in self.closed] + [
            (upto, opening) for _, _, opening, entries in self.open for upto in entries]
        states.sort(key=lambda piece: piece[0])
        return [piece for piece, later in zip(states, [*states[1:], (None, 0)])
                if piece[1] is not later[1]]


def _after(pieces: list[dict], state: Opening | None) -> Opening | None:
    """State after a chunk, given the state before it."""
    since = _LOWEST if state is None else state.start_us
    for piece in pieces:
        if since <= piece["upto"]:
            if not piece["is_open"]:
                return None
            return Opening(*[piece[name] for name in _OPENING])
    return state


_ROW_COLUMNS = ["msn", "event_tblrefid", "chunk", "seq", "occurs", "start_us", "ends_us",
                "event_us", "arrival_us", *CONTEXT]
_SUMMARY_SCHEMA = pa.schema([*_KEY_FIELDS, pa.field("chunk", pa.int64()),
                             pa.field("pieces", pa.list_(_PIECE_TYPE))])
_CARRY_SCHEMA = pa.schema([*_KEY_FIELDS, pa.field("chunk", pa.int64()), *_OPENING_FIELDS])
_INCIDENT_SCHEMA = pa.schema([*_KEY_FIELDS, *_OPENING_FIELDS, pa.field("end_us", pa.int64()),
                              pa.field("end_arrival_us", pa.int64())])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, table = None, _Table()

    def finished() -> tuple:
        closed = (None,) * len(_OPENING)
        return (*key, [
            dict(zip(["upto", "is_open", *_OPENING], (upto, state is not None, *(state or closed))))
            for upto, state in table.pieces()])

    for batch in batches:
        out = []
        for msn, pair, chunk, seq, occurs, start, ends, _, arrival, *context in _tuples(
                batch, _ROW_COLUMNS):
            if (msn, pair, chunk) != key:
                if key is not None:
                    out.append(finished())
                key, table = (msn, pair, chunk), _Table()
            if occurs:
                table.occurs(Opening(start, seq, arrival, *context))
            else:
                table.restored(ends)
        yield _rows_to_batch(out, _SUMMARY_SCHEMA)
    if key is not None:
        yield _rows_to_batch([finished()], _SUMMARY_SCHEMA)


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open state before each chunk; a last row without chunk holds what is open at the end."""
    key, state = None, None
    for batch in batches:
        out = []
        for msn, pair, chunk, pieces in _tuples(batch, ["msn", "event_tblrefid", "chunk", "pieces"]):
            if (msn, pair) != key:
                if state is not None:
                    out.append((*key, None, *state))
                key, state = (msn, pair), None
            if state is not None:
                out.append((msn, pair, chunk, *state))
            state = _after(pieces, state)
        yield _rows_to_batch(out, _CARRY_SCHEMA)
    if state is not None:
        yield _rows_to_batch([(*key, None, *state)], _CARRY_SCHEMA)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    carried = [f"open_{name}" for name in _OPENING]
    for batch in batches:
        out = []
        opened = _tuples(batch, carried)
        for row, before in zip(_tuples(batch, _ROW_COLUMNS), opened):
            msn, pair, chunk, seq, occurs, start, ends, us, arrival, *context = row
            if (msn, pair, chunk) != key:
                key = (msn, pair, chunk)
                state = None if before[1] is None else Opening(*before)
            if occurs:
                if state is None:
                    state = Opening(start, seq, arrival, *context)
            elif state is not None and state.start_us <= ends:
                out.append((msn, pair, *state, us, arrival))
                state = None
        yield _rows_to_batch(out, _INCIDENT_SCHEMA)


def previous_states(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``previous_occurs``: the kind of the row before, per key in arrival order.

    Rows are windowed by chunk, so that one key spreads over tasks; the first row of a chunk takes
    the last row of the chunk before, known from one summary row per chunk.
    """
    key = ["msn", "event_tblrefid"]
    chunked = rows.withColumn("_chunk", F.floor(F.col("seq") / chunk_rows).cast("bigint"))
    lasts = chunked.groupBy(*key, "_chunk").agg(F.max_by("occurs", "seq").alias("_last"))
    before = lasts.select(*key, "_chunk", F.lag("_last").over(
        Window.partitionBy(*key).orderBy("_chunk")).alias("_carried"))
    order = Window.partitionBy(*key, "_chunk").orderBy("seq")
    return (
        chunked.withColumn("_was", F.lag("occurs").over(order))
        .join(before, [*key, "_chunk"])
        .withColumn("previous_occurs", F.coalesce("_was", "_carried"))
        .select(*rows.columns, "previous_occurs"))


def _without_idle_rows(rows: DataFrame) -> DataFrame:
    """Drop rows whose predecessor in the chunk makes them irrelevant.

    An occurrence right after an occurrence finds an outage open. A restoration right after a
    restoration that reaches at least as far finds nothing left to close.
    """
    order = Window.partitionBy("msn", "event_tblrefid", "chunk").orderBy("seq")
    previous = rows.withColumns({
        "_was": F.lag("occurs").over(order), "_reach": F.lag("ends_us").over(order)})
    idle = (F.col("_was") == F.col("occurs")) & (
        F.col("occurs") | (F.col("_reach") >= F.col("ends_us")))
    return previous.where(~F.coalesce(idle, F.lit(False))).drop("_was", "_reach")


_KEY = ["msn", "event_tblrefid"]
_CHUNK_KEY = [*_KEY, "chunk"]


def _neighbours(rows: DataFrame, value: Column, name: str, ahead: bool) -> DataFrame:
    """``value`` of the row before (or after) each row, across the chunks of a key."""
    order = Window.partitionBy(*_CHUNK_KEY).orderBy("seq")
    move, pick = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    edges = rows.groupBy(*_CHUNK_KEY).agg(pick(value, F.col("seq")).alias("_edge"))
    carried = edges.select(*_CHUNK_KEY, move("_edge").over(
        Window.partitionBy(*_KEY).orderBy("chunk")).alias("_carried"))
    return (
        rows.withColumn(name, move(value).over(order)).join(carried, _CHUNK_KEY)
        .withColumn(name, F.coalesce(name, "_carried")).drop("_carried"))


def _taking_turns(active: DataFrame) -> DataFrame:
    """The first row of each run of occurrences, with the restoration ``_next`` that follows it."""
    was = _neighbours(active, F.col("occurs"), "_was", ahead=False)
    turns = was.where(F.col("_was").isNull() | (F.col("_was") != F.col("occurs"))).drop("_was")
    following = F.struct("ends_us", "event_us", "arrival_us")
    return _neighbours(turns, following, "_next", ahead=True).where("occurs")


def _by_machine(active: DataFrame) -> DataFrame:
    """Incidents of keys that need the state machine."""
    summaries = active.repartition(*_CHUNK_KEY).sortWithinPartitions(*_CHUNK_KEY, "seq").mapInArrow(
        _summarise, f"{_KEY_TYPES}, chunk bigint, pieces array<{_PIECE}>")
    states = (
        summaries.repartition(*_KEY).sortWithinPartitions(*_CHUNK_KEY)
        .mapInArrow(_carry, f"{_KEY_TYPES}, chunk bigint, {_OPENING_TYPES}"))
    before = states.where(F.col("chunk").isNotNull()).select(
        *_CHUNK_KEY, *[F.col(name).alias(f"open_{name}") for name in _OPENING])
    closed = (
        active.join(before, _CHUNK_KEY, "left")
        .repartition(*_CHUNK_KEY).sortWithinPartitions(*_CHUNK_KEY, "seq")
        .mapInArrow(_replay, f"{_KEY_TYPES}, {_OPENING_TYPES}, end_us bigint, end_arrival_us bigint"))
    still_open = states.where(F.col("chunk").isNull()).drop("chunk").withColumns({
        "end_us": F.lit(None).cast("bigint"), "end_arrival_us": F.lit(None).cast("bigint")})
    return closed.unionByName(still_open)


def pair_incidents(
    rows: DataFrame, *, guard: bool = True, whole_seconds: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per incident; ``end_us`` is null while the outage is open.

    ``seq`` must be unique and rising in arrival order; ``chunk_rows`` consecutive values form a
    chunk. ``guard=False`` lets a restoration close an outage that started later;
    ``whole_seconds=False`` keeps the fraction of the start.
    """
    second = F.lit(1_000_000)
    start = (F.floor(F.col("event_us") / second) * second).cast("bigint")
    prepared = rows.select(
        *_KEY, F.floor(F.col("seq") / chunk_rows).cast("bigint").alias("chunk"),
        "seq", "occurs", (start if whole_seconds else F.col("event_us")).alias("start_us"),
        (F.col("event_us") if guard else F.lit(_HIGHEST)).alias("ends_us"),
        "event_us", "arrival_us", *CONTEXT)
    # Read by several passes, and far smaller than the events it was filtered from.
    active = materialise(
        _without_idle_rows(prepared.repartition(*_CHUNK_KEY)).select(*_ROW_COLUMNS))
    opened = materialise(_taking_turns(active))
    unordered = materialise(
        opened.where(F.col("_next.ends_us") < F.col("start_us")).select(*_KEY).distinct())
    simple = opened if unordered.isEmpty() else opened.join(unordered, _KEY, "left_anti")
    incidents = simple.select(
        *_KEY, "start_us", F.col("seq").alias("start_seq"),
        F.col("arrival_us").alias("start_arrival_us"), *CONTEXT,
        F.col("_next.event_us").alias("end_us"), F.col("_next.arrival_us").alias("end_arrival_us"))
    if unordered.isEmpty():
        return incidents
    return incidents.unionByName(_by_machine(active.join(unordered, _KEY, "left_semi")))


# ---- incident records ------------------------------------------------------------------------

INCIDENT_COLUMNS = [
    "incident_id", "msn", "event_name", "event_tblrefid", "incident_status", "start_ts", "end_ts",
    "duration_minutes", "dtr_name", "dtr_network_code", "feeder_name", "substation_name",
]


def incident_log(
    incidents: DataFrame, unresolved: str | None = "event",
    unresolved_after_us: int = UNRESOLVED_AFTER_US,
) -> DataFrame:
    """OPEN, UNRESOLVED and CLOSED rows of every incident.

    An incident is UNRESOLVED when no restoration followed within the delay: by event time
    (``"event"``), by arrival time (``"arrival"``), or never reported (None).
    """
    clock = {"event": ("start_us", "end_us"), "arrival": ("start_arrival_us", "end_arrival_us")}
    statuses = [F.struct(F.lit("OPEN").alias("incident_status"),
                         F.lit(None).cast("string").alias("end_ts"),
                         F.lit(None).cast("double").alias("duration_minutes"))]
    if unresolved is not None:
        started, ended = clock[unresolved]
        overdue = F.col(ended).isNull() | (F.col(ended) - F.col(started) > unresolved_after_us)
        statuses.append(F.when(overdue, F.struct(
            F.lit("UNRESOLVED").alias("incident_status"),
            F.lit(None).cast("string").alias("end_ts"),
            F.lit(unresolved_after_us / 60e6).alias("duration_minutes"))))
    statuses.append(F.when(F.col("end_us").isNotNull(), F.struct(
        F.lit("CLOSED").alias("incident_status"), seconds_text(F.col("end_us")).alias("end_ts"),
        minutes_between(F.col("start_us"), F.col("end_us")).alias("duration_minutes"))))
    incident_id = F.concat_ws(
        ":", "msn", F.col("event_tblrefid").cast("string"),
        seconds_text(F.col("start_us"), "yyyy-MM-dd'T'HH:mm:ss"))
    return (
        incidents.withColumns({
            "incident_id": incident_id, "start_ts": seconds_text(F.col("start_us")),
            "s": F.explode(F.array_compact(F.array(*statuses)))})
        .select("*", "s.*").select(*INCIDENT_COLUMNS))


def service_records(rows: DataFrame) -> DataFrame:
    """Ids, times and minutes of the service variant for rows with ``incident_status``."""
    closed = F.col("incident_status") == "CLOSED"
    return rows.withColumns({
        "incident_id": F.concat_ws(
            ":", "msn", F.col("event_tblrefid").cast("string"), micros_text(F.col("start_us"), "T")),
        "start_ts": micros_text(F.col("start_us")),
        "end_ts": F.when(closed, micros_text(F.col("end_us"))),
        "duration_minutes": F.when(closed, F.bround(
            (F.col("end_us") - F.col("start_us")) / F.lit(60e6), 2))})


def service_incident_log(incidents: DataFrame) -> DataFrame:
    """The service variant: fractions kept in ids and times, minutes rounded to 2, no alerts."""
    statuses = F.array_compact(F.array(
        F.lit("OPEN"), F.when(F.col("end_us").isNotNull(), F.lit("CLOSED"))))
    return service_records(
        incidents.withColumn("incident_status", F.explode(statuses))).select(*INCIDENT_COLUMNS)


def outage_incidents(
    enriched: DataFrame, unresolved: str | None = "event", arrival_us: Column | None = None,
    **options,
) -> DataFrame:
    """Enriched events to the incident log; judging by arrival time needs the arrival column."""
    if unresolved == "arrival" and arrival_us is None:
        raise ValueError("unresolved by arrival time needs arrival_us")
    return incident_log(pair_incidents(outage_rows(enriched, arrival_us), **options), unresolved)


def service_incidents(enriched: DataFrame, **options) -> DataFrame:
    """Enriched events to the incident log of the service variant."""
    return service_incident_log(pair_incidents(
        service_rows(enriched), guard=False, whole_seconds=False, **options))
