"""Replay order of historical events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterflow.functions import control_trim, dt_bucket_us, event_us


def with_replay_time(events: DataFrame, timing: str = "auto") -> DataFrame:
    """Add ``replay_us`` from the ``dt`` bucket, from ``ts``, or (auto) from ``dt`` if present."""
    bucket = dt_bucket_us(F.col("dt"))
    exact = event_us(control_trim(F.col("ts")))
    chosen = {
        "dt": bucket,
        "ts": exact,
        "auto": F.when(F.coalesce(F.col("dt"), F.lit("")) != "", bucket).otherwise(exact),
    }
    if timing not in chosen:
        raise ValueError(f"timing must be one of {sorted(chosen)}")
    return events.withColumn("replay_us", chosen[timing])


def replay_order(events: DataFrame, timing: str = "auto") -> DataFrame:
    """Events in replay order; arrival order breaks ties. The sort is range partitioned."""
    return with_replay_time(events, timing).orderBy(F.col("replay_us").asc_nulls_last(), "seq")


def stamp_replayed(events: DataFrame) -> DataFrame:
    """Add ``replayed_at``: the present time, ISO with offset, milliseconds."""
    return events.withColumn(
        "replayed_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"))
