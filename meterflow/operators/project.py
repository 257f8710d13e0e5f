"""Closed projections of the enriched event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.schemas import PROCESSED_EVENT, PROCESSED_EVENT_NARROW, column_names
from meterflow.operators.enrich import HIERARCHY_COLUMNS, SQL_CATALOGUE_COLUMNS


def _select_typed(events: DataFrame, ddl: str) -> DataFrame:
    pairs = [part.split(None, 1) for part in ddl.split(", ")]
    return events.select(*[F.col(name).cast(kind).alias(name) for name, kind in pairs])


def processed_events(enriched: DataFrame) -> DataFrame:
    """The 23-column processed event; ``ts`` becomes ``event_ts``, anything else is dropped."""
    return _select_typed(enriched.withColumn("event_ts", F.col("ts")), PROCESSED_EVENT)


def processed_events_narrow(events: DataFrame) -> DataFrame:
    """The 10-column form without enrichment."""
    named = events if "event_ts" in events.columns else events.withColumn("event_ts", F.col("ts"))
    return _select_typed(named, PROCESSED_EVENT_NARROW)


def enriched_events_sql(events: DataFrame) -> DataFrame:
    """The 20-column enriched event of the SQL pipeline."""
    return events.select(
        *column_names(PROCESSED_EVENT_NARROW), *SQL_CATALOGUE_COLUMNS, *HIERARCHY_COLUMNS)


def record_json(rows: DataFrame) -> Column:
    """A row as a JSON record: nulls written out, times as ``yyyy-MM-dd HH:mm:ss``."""
    return F.to_json(F.struct(*rows.columns), {
        "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss"})


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON ``value`` per row."""
    return rows.select(record_json(rows).alias("value"))
