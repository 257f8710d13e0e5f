"""Raw JSON payload to typed event columns.

The payload is parsed once; every later step works on typed columns. Voltages are
kept twice: coerced (``v_r``: numeric text counts) for the projection and strict (``v_r_num``:
JSON numbers only) for the feature aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import (
    as_double, as_integer, control_trim, event_us, is_blank, strict_number,
)
from meterflow.functions.texts import PADDING

PHASES = ("v_r", "v_y", "v_b")

# Texts keep whatever the message held; the phases keep the JSON type as well.
_DOCUMENT = (
    "array<struct<msn: string, msn_id: string, evnt_id: string, ts: string, log_seq_no: string, "
    "dt: string, latitude: string, longitude: string, "
    "v_r: variant, v_y: variant, v_b: variant>>"
)
_JSON_OPTIONS = {"allowNonNumericNumbers": "false"}


def _documents(payload: str) -> Column:
    """The message as an array of one document; null when it is not a JSON object."""
    looks_like_object = F.ltrim(F.col(payload), F.lit(PADDING)).startswith("{")
    return F.from_json(F.when(looks_like_object, F.col(payload)), _DOCUMENT, _JSON_OPTIONS)


def parse_events(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed columns of every message that is a JSON object; the rest go to ``quarantine``.

    Other input columns (arrival order ``seq``, the payload itself) pass through. ``event_us`` is
    the event time in UTC microseconds, null when ``ts`` does not parse after trimming.

    The generator drops broken messages while it parses, and later filters stay above it. A plain
    filter on the parsed column would be pushed below the projection and parse a second time.
    """
    kept = [name for name in messages.columns if name not in ("latitude", "longitude")]
    documents = messages.select(*kept, F.inline(_documents(payload)))
    typed = {
        "msn_id": as_integer(F.col("msn_id"), "bigint"),
        "evnt_id": as_integer(F.col("evnt_id"), "int"),
        "log_seq_no": as_integer(F.col("log_seq_no"), "bigint"),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
        **{phase: as_double(F.col(phase)) for phase in PHASES},
        **{f"{phase}_num": strict_number(F.col(phase)) for phase in PHASES},
        "event_us": event_us(control_trim(F.col("ts"))),
    }
    return documents.withColumns(typed)


def quarantine(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Messages that are not JSON objects, with the reason."""
    parsed = F.try_parse_json(F.col(payload))
    return messages.where(_documents(payload).isNull()).withColumn(
        "reject_reason", F.when(parsed.isNull(), "MALFORMED").otherwise("NOT_AN_OBJECT"))


def parse_events_sql(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """The eight typed columns by text extraction and casts, plus ``raw_payload``.

    No row is dropped: broken payloads give null columns.
    """
    fields = F.from_json(
        F.col(payload),
        "msn string, msn_id string, evnt_id string, ts string, log_seq_no string, "
        "v_r string, v_y string, v_b string",
        # Any option keeps the optimizer from splitting this into one parse per field.
        {"mode": "PERMISSIVE"})
    return messages.withColumn("fields", fields).select(
        *[name for name in messages.columns if name != payload],
        F.col("fields.msn").alias("msn"),
        F.col("fields.msn_id").try_cast("bigint").alias("msn_id"),
        F.col("fields.evnt_id").try_cast("int").alias("evnt_id"),
        F.col("fields.ts").alias("event_ts"),
        F.col("fields.log_seq_no").try_cast("bigint").alias("log_seq_no"),
        *[F.col(f"fields.{phase}").try_cast("double").alias(phase) for phase in PHASES],
        F.col(payload).alias("raw_payload"),
    )


def validate(events: DataFrame) -> DataFrame:
    """Flag rows without a meter id; nothing is dropped."""
    missing = is_blank(F.col("msn"))
    return events.withColumns({
        "validation_status": F.when(missing, "INVALID").otherwise("VALID"),
        "validation_reason": F.when(missing, "MSN is null or blank"),
    })


def validate_sql(events: DataFrame) -> DataFrame:
    """The code-word form: only spaces count as blank."""
    missing = F.col("msn").isNull() | (F.trim("msn") == "")
    return events.withColumns({
        "validation_status": F.when(missing, "FAIL").otherwise("PASS"),
        "validation_reason": F.when(missing, "MISSING_MSN"),
    })
