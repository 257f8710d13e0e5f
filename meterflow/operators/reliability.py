"""Supply-reliability aggregates over the incident log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.operators.skew import exact_percentile

LEVELS = {
    "meter": "msn",
    "transformer": "dtr_name",
    "feeder": "feeder_name",
    "substation": "substation_name",
    "day": "day",
}
NO_NAME = "\u0000"
_STATUS_RANK = "case incident_status when 'OPEN' then 0 when 'UNRESOLVED' then 1 else 2 end"


def latest_per_incident(log: DataFrame) -> DataFrame:
    """The furthest status of each incident; the later arrival decides among equals."""
    arrival = F.col("received_at") if "received_at" in log.columns else F.lit(0)
    values = [name for name in log.columns if name != "incident_id"]
    return (
        log.groupBy("incident_id")
        .agg(F.max_by(F.struct(*values), F.struct(
            F.expr(_STATUS_RANK), arrival, F.coalesce("end_ts", F.lit("")))).alias("last"))
        .select("incident_id", "last.*"))


def active_incidents(log: DataFrame) -> DataFrame:
    """Opened incidents without a CLOSED row."""
    closed = log.where(F.col("incident_status") == "CLOSED").select("incident_id").distinct()
    return log.where(F.col("incident_status") == "OPEN").join(closed, "incident_id", "left_anti")


def _per_level(rows: DataFrame) -> DataFrame:
    """Each row once per reporting level, as (level, name)."""
    dated = rows.withColumn("day", F.substring("start_ts", 1, 10))
    pairs = F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(column).alias("name"))
        for level, column in LEVELS.items()])
    return dated.withColumn("_pair", F.explode(pairs)).select("*", "_pair.*").drop("_pair")


def outage_frequency(log: DataFrame) -> DataFrame:
    """Number of outages per meter, transformer, feeder, substation and day."""
    opened = log.where(F.col("incident_status") == "OPEN")
    return _per_level(opened).groupBy("level", "name").agg(F.count("*").alias("outages"))


def restoration_activity(log: DataFrame) -> DataFrame:
    """Opened, alerted and closed counts and the share closed, per level."""
    status = F.col("incident_status")
    return (
        _per_level(log).groupBy("level", "name")
        .agg(F.count_if(status == "OPEN").alias("opened"),
             F.count_if(status == "UNRESOLVED").alias("unresolved"),
             F.count_if(status == "CLOSED").alias("closed"))
        .withColumn("share_closed", F.col("closed") / F.nullif(F.col("opened"), F.lit(0))))


def _total_ms() -> Column:
    """Durations summed as whole milliseconds, so that the order of addition cannot matter."""
    return F.sum(F.round(F.col("duration_minutes") * 60000).cast("bigint"))


def _total_and_mean(count: str) -> dict[str, Column]:
    total = F.col("_ms") / F.lit(60000.0)
    return {"total_minutes": total, "mean_minutes": total / F.col(count)}


def outage_duration(log: DataFrame) -> DataFrame:
    """Sum, mean, maximum and exact median of the closed minutes, per level."""
    # A missing name is a group of its own; the joins below need a value for it.
    closed = _per_level(log.where(F.col("incident_status") == "CLOSED")).select(
        "level", F.coalesce("name", F.lit(NO_NAME)).alias("name"), F.col("duration_minutes"))
    totals = (
        closed.groupBy("level", "name")
        .agg(F.count("*").alias("closed"), _total_ms().alias("_ms"),
             F.max("duration_minutes").alias("max_minutes"))
        .withColumns(_total_and_mean("closed")).drop("_ms"))
    median = exact_percentile(
        closed, ["level", "name"], "duration_minutes", 0.5, bin_width=1.0, out="median_minutes")
    return totals.join(median, ["level", "name"]).withColumn(
        "name", F.nullif("name", F.lit(NO_NAME)))


def network_rollup(log: DataFrame) -> DataFrame:
    """Closed outages rolled up over substation, feeder and transformer.

    ``depth`` is 3 for a transformer row, 2 for a feeder, 1 for a substation, 0 for the network.
    """
    closed = log.where(F.col("incident_status") == "CLOSED")
    return (
        closed.rollup("substation_name", "feeder_name", "dtr_name")
        .agg(F.grouping_id().alias("_grouping"), F.count("*").alias("outages"),
             _total_ms().alias("_ms"))
        .withColumns(_total_and_mean("outages"))
        .withColumn("depth", 3 - F.bit_count("_grouping")).drop("_grouping", "_ms"))


# ---- the same aggregates in parts that add up ------------------------------------------------

def level_counts(log: DataFrame) -> DataFrame:
    """Per level and name what the reports are made of; parts of a log add up by ``merged_counts``."""
    status = F.col("incident_status")
    closed = status == "CLOSED"
    return _per_level(log).groupBy("level", "name").agg(
        F.count_if(status == "OPEN").alias("opened"),
        F.count_if(status == "UNRESOLVED").alias("unresolved"),
        F.count_if(closed).alias("closed"),
        F.sum(F.when(closed, F.round(F.col("duration_minutes") * 60000).cast("bigint"))).alias("ms"),
        F.max(F.when(closed, F.col("duration_minutes"))).alias("max_minutes"))


def merged_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("level", "name").agg(
        *[F.sum(name).alias(name) for name in ("opened", "unresolved", "closed", "ms")],
        F.max("max_minutes").alias("max_minutes"))


def reports_of(counts: DataFrame) -> DataFrame:
    """Frequency, restoration and duration of merged counts; the median needs the log itself."""
    total = F.col("ms") / F.lit(60000.0)
    return counts.select(
        "level", "name", "opened", "unresolved", "closed",
        (F.col("closed") / F.nullif(F.col("opened"), F.lit(0))).alias("share_closed"),
        total.alias("total_minutes"), (total / F.nullif(F.col("closed"), F.lit(0))).alias("mean_minutes"),
        "max_minutes")


_NETWORK = ["substation_name", "feeder_name", "dtr_name"]


def network_counts(log: DataFrame) -> DataFrame:
    """Closed outages and their time per transformer; parts add up by ``merged_network``."""
    return log.where(F.col("incident_status") == "CLOSED").groupBy(*_NETWORK).agg(
        F.count("*").alias("outages"), _total_ms().alias("ms"))


def merged_network(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_NETWORK).agg(F.sum("outages").alias("outages"), F.sum("ms").alias("ms"))


def rollup_of(counts: DataFrame) -> DataFrame:
    """``network_rollup`` of merged counts."""
    total = F.col("ms") / F.lit(60000.0)
    return (
        counts.rollup(*_NETWORK)
        .agg(F.grouping_id().alias("_grouping"), F.sum("outages").alias("outages"), F.sum("ms").alias("ms"))
        .select(*_NETWORK, "outages", total.alias("total_minutes"),
                (total / F.col("outages")).alias("mean_minutes"),
                (3 - F.bit_count("_grouping")).alias("depth")))
