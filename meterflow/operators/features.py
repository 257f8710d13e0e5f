"""Per-meter 15-minute features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import control_trim, is_blank, same_text
from meterflow.operators.parse import PHASES

WINDOW = "15 minutes"
LATENESS = "5 seconds"


def is_power_failure_occurrence() -> Column:
    return (same_text(control_trim(F.col("event_name")), "Power failure")
            & same_text(control_trim(F.col("event_state")), "OCCURRENCE"))


def eligible(events: DataFrame) -> DataFrame:
    """Valid rows with a meter id and a readable timestamp."""
    return events.where(
        same_text(F.col("validation_status"), "VALID")
        & ~is_blank(F.col("msn")) & F.col("event_us").isNotNull())


def meter_features(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Counts, mean phase voltage and voltage range per meter and tumbling window.

    All aggregates combine map-side, so a meter with most of the rows costs one buffer per task
    and window. With ``watermark`` the same plan runs on a stream in append mode.
    """
    numeric = [F.col(f"{phase}_num") for phase in PHASES]
    row_count = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in numeric])
    row_sum = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in numeric])
    rows = eligible(events).select(
        control_trim(F.col("msn")).alias("msn"),
        F.timestamp_micros("event_us").alias("event_time"),
        row_count.alias("readings"), row_sum.alias("reading_sum"),
        F.greatest(*numeric).alias("high"), F.least(*numeric).alias("low"),
        is_power_failure_occurrence().alias("failure"),
    )
    if watermark is not None:
        rows = rows.withWatermark("event_time", watermark)
    return (
        rows.groupBy("msn", F.window("event_time", WINDOW).alias("w"))
        .agg(
            F.count("*").alias("event_count_15m"),
            (F.sum("reading_sum") / F.nullif(F.sum("readings"), F.lit(0))).alias("avg_voltage_15m"),
            (F.max("high") - F.min("low")).alias("voltage_range_15m"),
            F.count_if("failure").alias("power_failure_count_15m"),
        )
        .select(
            "msn", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "event_count_15m", "avg_voltage_15m", "voltage_range_15m", "power_failure_count_15m")
    )
