"""Join and ranking helpers that hold when one key dominates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterflow.session import shared_dir

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
PARTS = 4096
# A lookup key repeated more often than this has its fan-out spread over so many slices.
FAN_OUT_ROWS, FAN_OUT_SLICES = 64, 256


def fits_broadcast(
    source: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """Measure a lookup source: its rows and the bytes of its values, by one aggregate.

    Counted whole and combined map-side: a limit would gather up to its number of rows from
    every partition in one task, just when the source is too large.
    """
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 8
         for name in source.columns])
    rows, size = source.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(lookup: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast only after measuring the lookup, or the source it is a subset of.

    A larger lookup is returned without hint: it is joined by shuffle, where adaptive execution
    splits hot keys.
    """
    return F.broadcast(lookup) if fits_broadcast(source or lookup) else lookup


def materialise(rows: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, for rows that several later steps read."""
    shared_dir(rows.sparkSession)
    return rows.checkpoint()


def spread_missing(key: Column, *row: Column, buckets: int = 4096) -> Column:
    """A join key whose null values are spread over many values that match nothing.

    Rows without key would otherwise hash to one task of a shuffled outer join.
    """
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*row), F.lit(buckets)).cast("string"))
    return F.coalesce(key, filler)


def join_repeated(
    rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, *row: Column,
    repeats: int = FAN_OUT_ROWS, slices: int = FAN_OUT_SLICES,
) -> DataFrame:
    """Left join to a lookup that may repeat a key: every pair, without all pairs of a key in one task.

    Adaptive execution sizes tasks by the bytes they read, but what a repeated key costs is the rows it gives. Rows of a
    key with more than ``repeats`` lookup rows are spread over ``slices`` by a hash of ``row``, and the lookup rows
    of that key are copied to every slice. These keys have a join of their own, whose tasks are as many as slices and are
    not put together for reading little; the other keys are joined before, as adaptive execution likes. ``key`` is dropped.
    """
    often = lookup.groupBy(lookup_key).agg(F.count("*").alias("_n")).where(
        F.col("_n") > repeats).where(F.col(lookup_key).isNotNull())
    often = materialise(often.select(F.col(lookup_key).alias("_often")))
    if often.isEmpty():
        return rows.withColumn(key, spread_missing(F.col(key), *row)).join(
            lookup, F.col(key) == F.col(lookup_key), "left").drop(key)
    often = broadcast_if_small(often)
    repeated = F.col("_often").isNotNull()
    sliced = rows.join(often, F.col(key) == F.col("_often"), "left").withColumns({
        key: spread_missing(F.when(~repeated, F.col(key)), *row),
        "_spread": spread_missing(F.col("_often"), *row),
        "_slice": F.pmod(F.xxhash64(*row), F.lit(slices)).cast("int")})
    seldom = lookup.join(often, F.col(lookup_key) == F.col("_often"), "left_anti")
    found = sliced.join(seldom, F.col(key) == F.col(lookup_key), "left").drop(key)
    copied = lookup.join(often, F.col(lookup_key) == F.col("_often")).select(
        "_often", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_copy"),
        *[F.col(name).alias(f"_copied_{name}") for name in lookup.columns]).withColumnRenamed("_often", "_of")
    joined = found.repartition(slices, "_spread", "_slice").join(
        copied.repartition(slices, "_of", "_copy"),
        (F.col("_spread") == F.col("_of")) & (F.col("_slice") == F.col("_copy")), "left")
    return joined.select(
        *[name for name in rows.columns if name != key],
        *[F.when(repeated, F.col(f"_copied_{name}")).otherwise(F.col(name)).alias(name) for name in lookup.columns])


def last_wins(lookup: DataFrame, key: str, ordinal: str = "ordinal") -> DataFrame:
    """One row per key, the one read last."""
    values = [name for name in lookup.columns if name not in (key, ordinal)]
    return (
        lookup.groupBy(key)
        .agg(F.max_by(F.struct(*values), F.col(ordinal)).alias("last"))
        .select(key, *[F.col(f"last.{name}").alias(name) for name in values])
    )


def with_positions(placed: DataFrame, position: str) -> DataFrame:
    """Number the rows of a materialised table 0..n-1 in the order of its partitions.

    Only the row counts of the partitions are added up in a single task.
    """
    marked = placed.withColumn("_place", F.monotonically_increasing_id())
    split = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = marked.groupBy(split.alias("_split")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_split", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    # One row per partition: bounded by the partition count.
    return (
        marked.withColumn("_split", split).join(F.broadcast(offsets), "_split")
        .withColumn(position, F.col("_offset") + within).drop("_split", "_offset", "_place"))


def global_rank(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Number rows 1..n in a total order without sending all of them through one task.

    Rows are range partitioned and sorted; each partition's offset is the number of rows before it.
    The input is materialised first, as range partitioning samples it before shuffling it, and
    again once placed, so that counting and numbering see the same layout.
    """
    placed = materialise(
        materialise(rows).repartitionByRange(*order).sortWithinPartitions(*order))
    return with_positions(placed, "_position").withColumn(
        rank, F.col("_position") + 1).drop("_position")


def exact_percentile(
    rows: DataFrame, group: list[str], value: str, fraction: float, bin_width: float,
    out: str = "percentile",
) -> DataFrame:
    """Exact percentile with linear interpolation, one row per group.

    The built-in ``percentile`` keeps every distinct value of a group in one buffer. Here no value
    is shuffled: a histogram of ``bin_width`` wide bins, combined map-side, locates the bin of the
    wanted place; the rows of that bin alone are kept, in its range ``PARTS`` finer bins are counted,
    and so on until a bin holds one value. That takes about ``log(rows) / log(PARTS)`` passes, of
    which the first two see all rows. Each bin knows the smallest value behind it, the other
    end of the interpolation. NaN is the largest value. Null values are left out, a group without
    others has no row. Group columns must not be null.
    """
    keys = group or ["_all"]
    left = materialise(rows.where(F.col(value).isNotNull()).select(
        *(group or [F.lit(1).alias("_all")]), F.col(value).alias("_v")))
    # Values beyond the whole numbers share the outermost bins; NaN belongs to the last.
    last = F.lit((1 << 63) - 1)
    counted = _bins(left.withColumn("_bin", F.when(F.isnan("_v"), last).otherwise(
        F.floor(F.col("_v").cast("double") / bin_width))), keys)
    places = (F.sum("_n").over(Window.partitionBy(*keys)) - 1) * F.lit(float(fraction))
    found = materialise(_located(counted.select(
        "*", places.alias("_pos"), F.lit(0).cast("bigint").alias("_base"),
        F.lit(None).cast(left.schema["_v"].dataType).alias("_beyond")), keys))
    while not (wide := found.where("_low < _high")).isEmpty():
        target = wide.withColumnsRenamed({"_low": "_from", "_high": "_to"}).drop("_n")
        inside = left.join(broadcast_if_small(target), keys).where("_v between _from and _to")
        # What the next pass reads: one bin of each group that is still open.
        left = materialise(inside.select(*keys, "_v"))
        finer = _bins(
            left.join(broadcast_if_small(target), keys).withColumn("_bin", _part()), keys,
            "_pos", "_base", "_beyond")
        found = materialise(found.where("not _low < _high").unionByName(_located(finer, keys)))
    high = F.when(F.col("_base") + F.col("_n") > F.ceil("_pos"), F.col("_low")).otherwise(F.col("_beyond"))
    share = F.col("_pos") - F.floor("_pos")
    # Without a share there is nothing to add, even to an infinite value.
    return found.select(*group, F.when(share > 0, F.col("_low") + (high - F.col("_low")) * share).otherwise(
        F.col("_low").cast("double")).alias(out))


def _bins(values: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """Rows, smallest and largest value of each bin; ``carried`` are equal within a group."""
    return values.groupBy(*keys, "_bin").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        *[F.first(name).alias(name) for name in carried])


def _part() -> Column:
    """The bin of ``_v`` in ``PARTS`` equal ones from ``_from`` to ``_to``.

    Both ends have a bin of their own, so every pass leaves fewer values, however they are spread.
    """
    v, low, high = (F.col(name).cast("double") for name in ("_v", "_from", "_to"))
    endless = F.lit(float("inf"))
    # Halves where the range itself is too large for a double; none where an end is infinite or NaN.
    within = (
        F.when(high - low < endless, (v - low) / F.nullif(high - low, F.lit(0.0)))
        .when((low > -endless) & (high < endless), (v / 2 - low / 2) / (high / 2 - low / 2)))
    middle = F.coalesce(F.least(F.floor(within * PARTS), F.lit(PARTS - 1)), F.lit(0)) + 1
    return (
        F.when(F.col("_v") == F.col("_from"), 0).when(F.col("_v") == F.col("_to"), PARTS + 1)
        .otherwise(middle).cast("bigint"))


def _located(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the bin that holds the place below ``_pos``, with ``_base`` the rows before it
    and ``_beyond`` the smallest value behind it. One row per bin is ordered, no values.
    """
    in_order = Window.partitionBy(*keys).orderBy("_bin")
    upto = F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        counted.select(
            *keys, "_n", "_low", "_high", "_pos", (F.col("_base") + upto).alias("_upto"),
            F.coalesce(F.lead("_low").over(in_order), F.col("_beyond")).alias("_beyond"))
        .withColumn("_base", F.col("_upto") - F.col("_n"))
        .where((F.col("_upto") > F.floor("_pos")) & (F.col("_base") <= F.floor("_pos")))
        .drop("_upto"))
