"""Likely feeders of meters missing from the network hierarchy.

An outage of an unknown meter is compared with the outages of known meters in the five minutes
before it: per feeder, how many distinct meters failed, and how far their centroid is.

Pairing every unknown outage with every recent known outage grows with the square of the event
rate, so the known side is first folded into one step function of time per feeder:

* per (feeder, meter) each outage stands for the meter from the moment the previous one expires
  until it expires itself, so at any time a meter counts once, with its earliest coordinates;
* entering and leaving are +1 / -1 changes; their running sums per feeder give the number of
  meters and the coordinate sums between two changes;
* an unknown outage is laid once into the steps of each feeder asked for it and takes the step in
  force there. For the three best, only feeders near it or leading by support are asked, so the
  work per outage does not grow with the number of feeders.

Time is cut into buckets so that all this is keyed by (feeder, bucket) or (bucket) and runs in
parallel; within a bucket, changes before its start collapse into one row. Evidence is ordered by
event time, arrival order deciding among equal times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterflow.functions import haversine_km, is_blank, iso_local, linear_decay, round_half_up
from meterflow.functions import event_us, same_text
from meterflow.functions.numbers import EARTH_RADIUS_KM
from meterflow.operators.outage import OCCURRENCE, POWER_FAILURE
from meterflow.operators.skew import materialise

LOOKBACK_US = 300 * 1_000_000
COOCCURRENCE_WEIGHT, PROXIMITY_WEIGHT = 0.70, 0.30
PROXIMITY_ZERO_KM = 20.0
TOP = 3
BUCKET_US = 60 * 1_000_000
# Leaves of the tree of moments in a bucket, 2 ** LEVELS of them.
LEVELS = 12
FEW_FEEDERS = 32
# Chord of the proximity radius on the unit sphere, a little more for rounding.
CELL_EDGE = 2 * math.sin(PROXIMITY_ZERO_KM / (2 * EARTH_RADIUS_KM)) * 1.001

USE_CASE = "topology-inference"
BEST_REASON = "Highest combined outage co-occurrence and geographic proximity score."
OTHER_REASON = "Alternative candidate based on recent outage and geographic evidence."
OTHER_RECOMMENDATION = "Retain as an alternative feeder candidate."

_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def outage_occurrences(enriched: DataFrame) -> DataFrame:
    """Power-failure occurrences with meter id and a timestamp that parses untrimmed."""
    occurred = enriched.where(
        same_text(F.col("event_name"), POWER_FAILURE)
        & same_text(F.col("event_state"), OCCURRENCE)
        & ~is_blank(F.col("msn")))
    return (
        occurred.withColumn("us", event_us(F.col("ts"))).where(F.col("us").isNotNull())
        .select("msn", "ts", "us", "seq", "hierarchy_match", "feeder_name", "substation_name",
                "latitude", "longitude"))


def known_evidence(occurrences: DataFrame) -> DataFrame:
    """Occurrences of meters in the hierarchy, with feeder and coordinates."""
    return occurrences.where(
        F.col("hierarchy_match") & ~is_blank(F.col("feeder_name"))
        & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def unknown_outages(occurrences: DataFrame) -> DataFrame:
    """Occurrences of meters outside the hierarchy, with coordinates."""
    return occurrences.where(
        ~F.col("hierarchy_match") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def _bucket(us: Column, bucket_us: int) -> Column:
    return F.floor(us / F.lit(bucket_us)).cast("bigint")


def evidence_steps(known: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """Support per (bucket, feeder) between two changes.

    A row holds for positions (time, arrival) after ``(from_us, from_seq)`` up to and including
    ``(to_us, to_seq)``; ``first_us``, ``first_seq`` and ``substation_name`` belong to the oldest
    outage that still counts.
    """
    # A meter reporting the same instant again adds nothing, so repeats vanish before the shuffle.
    distinct = known.groupBy("feeder_name", "msn", "us").agg(
        F.min("seq").alias("seq"),
        F.min_by(F.struct("latitude", "longitude", "substation_name"), "seq").alias("at"))
    reach = F.sequence(
        _bucket(F.col("us"), bucket_us), _bucket(F.col("us") + LOOKBACK_US, bucket_us))
    per_meter = Window.partitionBy("feeder_name", "msn", "bucket").orderBy("us")
    covered = (
        distinct.withColumn("bucket", F.explode(reach))
        .withColumn("expired", F.lag("us").over(per_meter) + LOOKBACK_US)
        .withColumns({"opens": F.col("bucket") * bucket_us,
                      "ends": (F.col("bucket") + 1) * bucket_us}))
    takes_over = F.col("expired") >= F.col("us")
    enter = F.when(takes_over, F.struct(F.col("expired").alias("us"), F.lit(_LAST).alias("seq"))
                   ).otherwise(F.struct("us", "seq"))
    enter = F.greatest(enter, F.struct(F.col("opens").alias("us"), F.lit(_FIRST).alias("seq")))
    leave = F.struct(
        F.least(F.col("us") + LOOKBACK_US, F.col("ends")).alias("us"), F.lit(_LAST).alias("seq"))
    oldest = F.struct("us", "seq", "at.substation_name")
    change = lambda position, sign, key: F.struct(
        position.alias("pos"), F.lit(sign).cast("bigint").alias("meters"),
        (F.lit(float(sign)) * F.col("at.latitude")).alias("lat"),
        (F.lit(float(sign)) * F.col("at.longitude")).alias("lon"), key.alias("leaving"))
    nobody = F.when(F.lit(False), oldest)
    changes = (
        covered.withColumn(
            "c", F.explode(F.array(change(enter, 1, nobody), change(leave, -1, oldest))))
        .groupBy("feeder_name", "bucket", F.col("c.pos").alias("pos"))
        .agg(F.sum("c.meters").alias("meters"), F.sum("c.lat").alias("lat"),
             F.sum("c.lon").alias("lon"), F.min("c.leaving").alias("leaving")))
    ordered = Window.partitionBy("feeder_name", "bucket").orderBy("pos")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The oldest counting outage is the next one to leave: look back over the reversed order.
    later = (Window.partitionBy("feeder_name", "bucket").orderBy(F.col("pos").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    return (
        changes.withColumns({
            "n": F.sum("meters").over(upto), "lat_sum": F.sum("lat").over(upto),
            "lon_sum": F.sum("lon").over(upto), "to": F.lead("pos").over(ordered),
            "first": F.last("leaving", ignorenulls=True).over(later)})
        .where(F.col("n") > 0)
        .select(
            "bucket", "feeder_name", F.col("first.substation_name").alias("substation_name"),
            "n", (F.col("lat_sum") / F.col("n")).alias("centroid_lat"),
            (F.col("lon_sum") / F.col("n")).alias("centroid_lon"),
            F.col("first.us").alias("first_us"), F.col("first.seq").alias("first_seq"),
            F.col("pos.us").alias("from_us"), F.col("pos.seq").alias("from_seq"),
            F.col("to.us").alias("to_us"), F.col("to.seq").alias("to_seq")))


def _leaf(us: Column, bucket_us: int) -> Column:
    """Leaf of its bucket that a time of column ``bucket`` falls into."""
    return F.floor((us - F.col("bucket") * bucket_us) * F.lit(1 << LEVELS) / F.lit(bucket_us)).cast("bigint")


def _spatial_cell(latitude: Column, longitude: Column) -> list[Column]:
    """Cube of space, its edge the chord of the proximity radius, that a point of the unit sphere lies in.

    Points within the radius lie in the same or adjoining cubes, at the poles and across the date line too.
    """
    lat, lon = F.radians(latitude), F.radians(longitude)
    return [F.floor(axis / F.lit(CELL_EDGE)).cast("bigint") for axis in (
        F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]


def _stretches(steps: DataFrame, bucket_us: int) -> DataFrame:
    """Each step's stretch of leaves it covers whole: ``a`` to ``b``, empty if ``a`` > ``b``."""
    opens = F.col("bucket") * bucket_us
    from_start = (F.col("from_us") == opens) & (F.col("from_seq") == _FIRST)
    return steps.withColumns({
        "leaf_from": F.when(~from_start, _leaf(F.col("from_us"), bucket_us)),
        "leaf_to": F.when(F.col("to_us") < opens + bucket_us, _leaf(F.col("to_us"), bucket_us)),
    }).withColumns({
        "a": F.coalesce(F.col("leaf_from") + 1, F.lit(0)),
        "b": F.coalesce(F.col("leaf_to") - 1, F.lit((1 << LEVELS) - 1))})


def _leading_by_support(steps: DataFrame, bucket_us: int) -> DataFrame:
    """``bucket``, ``level``, ``node`` and the ``TOP`` feeders by support among the steps cut into that node.

    A bucket's leaves form a binary tree; a stretch is cut into the fewest nodes, two a level at most, and
    each moment lies in one node a level. So the leading feeders of a moment are among the leading
    ones of its nodes, and no node keeps more than ``TOP``.
    """
    pieces = []
    for level in range(LEVELS + 1):
        first = lambda n: F.shiftright(F.col("a") + ((1 << n) - 1), n)
        last = lambda n: F.shiftright(F.col("b") + 1, n) - 1
        for node, other in ((first(level), None), (last(level), first(level))):
            above = F.shiftright(node, 1)
            kept = (first(level) <= last(level)) & ~above.between(first(level + 1), last(level + 1))
            if other is not None:
                kept = kept & (node != other)
            pieces.append(F.when(kept, F.struct(F.lit(level).alias("level"), node.alias("node"))))
    cut = _stretches(steps, bucket_us).where("a <= b").select(
        "bucket", "feeder_name", "n", "first_us", "first_seq",
        F.explode(F.array_compact(F.array(*pieces))).alias("at")).select(
        "bucket", "at.level", "at.node", "feeder_name", "n", "first_us", "first_seq")
    order = Window.partitionBy("bucket", "level", "node").orderBy(
        F.col("n").desc(), "first_us", "first_seq", "feeder_name")
    return cut.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP).select(
        "bucket", "level", "node", "feeder_name")


def asked_feeders(
    unknown: DataFrame, steps: DataFrame, bucket_us: int = BUCKET_US, every: bool = True,
) -> DataFrame:
    """One row per unknown outage and feeder to score.

    ``every`` asks each feeder with evidence in the outage's bucket. Otherwise only those that can be among the
    ``TOP`` best, and with them the one of largest support: beyond the proximity radius the score is the
    support share alone, so it takes the feeders near the outage, by cells of space, and the
    leading ones by support, by nodes of time. Feeders whose evidence changes in the very
    leaf of the outage are asked too; whether they count then is decided like for the others.
    """
    outages = unknown.select(
        "msn", "ts", "us", "seq", "latitude", "longitude",
        _bucket(F.col("us"), bucket_us).alias("bucket"))
    if every:
        return outages.join(steps.select("bucket", "feeder_name").distinct(), "bucket")
    names = outages.columns
    axes = ["cell_x", "cell_y", "cell_z"]
    around = outages.withColumns(dict(zip(axes, _spatial_cell(F.col("latitude"), F.col("longitude")))))
    for axis in axes:
        around = around.withColumn(axis, F.explode(F.array(*[F.col(axis) + F.lit(n) for n in (-1, 0, 1)])))
    near = steps.select("bucket", "feeder_name", *[
        cell.alias(axis) for axis, cell in zip(axes, _spatial_cell(F.col("centroid_lat"), F.col("centroid_lon")))
    ]).distinct()
    leaf = outages.withColumn("leaf", _leaf(F.col("us"), bucket_us))
    nodes = leaf.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn(
        "node", F.expr("shiftright(leaf, level)"))
    changing = _stretches(steps, bucket_us).select("bucket", "feeder_name", F.explode(
        F.array_compact(F.array("leaf_from", "leaf_to"))).alias("leaf")).distinct()
    columns = [*names, "feeder_name"]
    return (
        around.join(near, ["bucket", *axes]).select(*columns)
        .union(nodes.join(_leading_by_support(steps, bucket_us), ["bucket", "level", "node"]).select(*columns))
        .union(leaf.join(changing, ["bucket", "leaf"]).select(*columns)).distinct())


def candidates(
    occurrences: DataFrame, bucket_us: int = BUCKET_US, every: bool = True,
) -> DataFrame:
    """Unknown outages and the feeders asked for each (see ``asked_feeders``), scored and ranked.

    Ranks and support shares are those among all feeders with evidence, as far as the ``TOP`` best go.
    """
    # Read several times, and far smaller than the events they come from.
    occurrences = materialise(occurrences)
    steps = materialise(evidence_steps(known_evidence(occurrences), bucket_us))
    if not every:
        # Few feeders: fewer than the search for the best would ask about.
        every = steps.select(F.count_distinct("feeder_name")).first()[0] <= FEW_FEEDERS
    asked = asked_feeders(unknown_outages(occurrences), steps, bucket_us, every)
    values = ["substation_name", "n", "centroid_lat", "centroid_lon", "first_us", "first_seq",
              "to_us", "to_seq"]
    # A step holds after its position, so an outage at that very position comes before it.
    laid = steps.select(
        "bucket", "feeder_name", F.struct(
            F.col("from_us").alias("us"), F.col("from_seq").alias("seq")).alias("pos"),
        F.lit(1).alias("kind"), F.struct(*values).alias("step")).unionByName(
        asked.withColumns({"pos": F.struct("us", "seq"), "kind": F.lit(0)}),
        allowMissingColumns=True)
    sofar = Window.partitionBy("feeder_name", "bucket").orderBy("pos", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    until = F.col("pos") <= F.struct(F.col("step.to_us").alias("us"), F.col("step.to_seq").alias("seq"))
    met = (
        laid.withColumn("step", F.last("step", ignorenulls=True).over(sofar))
        .where((F.col("kind") == 0) & F.col("step").isNotNull() & until)
        .select("msn", "ts", "us", "seq", "latitude", "longitude", "feeder_name", "step.*"))
    # The rank is keyed by the outage, not the bucket: adaptive execution may then split a bucket
    # that holds many unknown outages, since no later step relies on its partitioning.
    per_outage = Window.partitionBy("msn", "us", "seq")
    distance = haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("centroid_lat"), F.col("centroid_lon"))
    scored = (
        met.withColumn("distance", distance)
        .withColumn("cooccurrence", F.col("n") / F.max("n").over(per_outage))
        .withColumn("proximity", linear_decay(F.col("distance"), PROXIMITY_ZERO_KM))
        .withColumn("score", COOCCURRENCE_WEIGHT * F.col("cooccurrence")
                    + PROXIMITY_WEIGHT * F.col("proximity")))
    best_first = per_outage.orderBy(
        F.col("score").desc(), F.col("n").desc(), "first_us", "first_seq")
    return scored.withColumn("candidate_rank", F.row_number().over(best_first))


def topology_results(occurrences: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """The three best feeders of each unknown outage as result records."""
    best = F.col("candidate_rank") == 1
    score = round_half_up(F.col("score"))
    return candidates(occurrences, bucket_us, every=False).where(F.col("candidate_rank") <= TOP).select(
        F.concat(F.col("msn"), F.lit(":"), iso_local(F.col("us"))).alias("inference_id"),
        F.lit(USE_CASE).alias("use_case"), F.col("msn").alias("unknown_msn"),
        F.col("ts").alias("event_ts"), "candidate_rank",
        F.col("feeder_name").alias("candidate_feeder"),
        F.coalesce("substation_name", F.lit("")).alias("candidate_substation"),
        F.col("n").alias("supporting_meter_count"),
        round_half_up(F.col("cooccurrence")).alias("cooccurrence_score"),
        round_half_up(F.col("distance")).alias("distance_km"),
        round_half_up(F.col("proximity")).alias("proximity_score"),
        score.alias("topology_score"), F.col("feeder_name").alias("prediction"),
        score.alias("confidence"), F.lit("INFO").alias("severity"),
        F.when(best, BEST_REASON).otherwise(OTHER_REASON).alias("reason"),
        F.when(best, F.concat(F.lit("Review feeder "), F.col("feeder_name"),
                              F.lit(" as the likely topology assignment.")))
        .otherwise(OTHER_RECOMMENDATION).alias("recommendation"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        .alias("generated_at"))
