"""Event catalogue and network hierarchy lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import blank_to_null, control_trim
from meterflow.operators.skew import (
    broadcast_if_small, fits_broadcast, join_repeated, last_wins, spread_missing,
)

CATALOGUE_COLUMNS = [
    "event_tblrefid", "event_name", "event_state", "isrestoration", "priorityname",
    "eventclassification_name",
]
HIERARCHY_COLUMNS = ["dtr_name", "dtr_network_code", "feeder_name", "substation_name"]
SQL_CATALOGUE_COLUMNS = [
    "event_name", "event_description", "event_tblrefid", "event_state", "priorityname",
    "eventclassification_name",
]


def catalogue_lookup(catalogue: DataFrame, columns: list[str] = CATALOGUE_COLUMNS) -> DataFrame:
    """One row per event id, the last one read; broadcast if measured small."""
    rows = catalogue.where(F.col("event_id").isNotNull()).select("ordinal", "event_id", *columns)
    return broadcast_if_small(last_wins(rows, "event_id"), rows)


def hierarchy_lookup(hierarchy: DataFrame) -> DataFrame:
    """One row per normalised meter id, blank ids dropped; broadcast if measured small."""
    key = F.upper(control_trim(F.col("msn_normalized")))
    rows = hierarchy.select(
        "ordinal", key.alias("msn_normalized"),
        *[blank_to_null(F.col(name)).alias(name) for name in HIERARCHY_COLUMNS],
    ).where(F.col("msn_normalized") != "")
    return broadcast_if_small(last_wins(rows, "msn_normalized"), rows)


def join_catalogue(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on the event id; unmatched rows get null columns and a false flag."""
    joined = events.join(lookup, events["evnt_id"] == lookup["event_id"], "left")
    return joined.withColumn("event_catalogue_match", F.col("event_id").isNotNull()).drop("event_id")


def _told_apart(events: DataFrame) -> list[Column]:
    """The row's number; all its values where rows are not numbered."""
    return [F.col("seq")] if "seq" in events.columns else [
        F.col(name) for name, kind in events.dtypes if not kind.startswith(("map", "variant"))]


def join_hierarchy(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on the trimmed, upper-cased meter id."""
    key = spread_missing(F.upper(blank_to_null(F.col("msn"))), *_told_apart(events))
    joined = events.withColumn("_meter", key)
    joined = joined.join(lookup, joined["_meter"] == lookup["msn_normalized"], "left").drop("_meter")
    return joined.withColumn("hierarchy_match", F.col("msn_normalized").isNotNull())


def enrich(events: DataFrame, catalogue: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Both lookups with match flags; the lookups carry an ``ordinal`` read order."""
    return join_hierarchy(
        join_catalogue(events, catalogue_lookup(catalogue)), hierarchy_lookup(hierarchy))


def enrich_sql(events: DataFrame, catalogue: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """The plain SQL pair of left joins: no flags, duplicate keys fan out, space-only trim.

    Blank ids match blank ids, so their rows are the product of both sides; it is spread over tasks.
    """
    cat = broadcast_if_small(catalogue.select("event_id", *SQL_CATALOGUE_COLUMNS))
    net = hierarchy.select("msn_normalized", *HIERARCHY_COLUMNS)
    row = _told_apart(events)
    joined = events.join(cat, events["evnt_id"] == cat["event_id"], "left").drop("event_id").withColumn(
        "_meter", F.upper(F.trim("msn")))
    if fits_broadcast(net):
        joined = joined.join(F.broadcast(net), F.col("_meter") == net["msn_normalized"], "left").drop("_meter")
    else:
        joined = join_repeated(joined, net, "_meter", "msn_normalized", *row)
    return joined.drop("msn_normalized")


def enrich_service(events: DataFrame, catalogue: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Dictionary-lookup form: last duplicate wins, event columns kept, no flags."""
    joined = join_catalogue(events, catalogue_lookup(catalogue, SQL_CATALOGUE_COLUMNS))
    joined = join_hierarchy(joined, hierarchy_lookup(hierarchy))
    return joined.drop("event_catalogue_match", "hierarchy_match", "msn_normalized")
