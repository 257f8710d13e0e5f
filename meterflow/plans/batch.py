"""The batch flow: raw messages to enriched events, and the results built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.operators.enrich import enrich
from meterflow.operators.parse import parse_events, validate
from meterflow.plans import derive


def enriched_events(messages: DataFrame, catalogue: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Parse, flag and enrich; works on a table and on a stream."""
    return enrich(validate(parse_events(messages)), catalogue, hierarchy)


def derived_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched events of the derived meter tables."""
    return enriched_events(
        derive.raw_messages(spark, sf_dir), derive.event_catalogue(spark),
        derive.network_hierarchy(spark, sf_dir))


def derived_enriched_stream(
    spark: SparkSession, sf_dir: str, parts: int | None = None,
) -> DataFrame:
    """The same as a stream, with static lookups; ``parts`` files come one per micro-batch."""
    return enriched_events(
        derive.raw_message_stream(spark, sf_dir, parts), derive.event_catalogue(spark),
        derive.network_hierarchy(spark, sf_dir))
