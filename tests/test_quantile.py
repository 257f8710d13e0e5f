"""Exact percentiles by narrowing histograms: any spread of values, few rows shuffled."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.operators.skew import PARTS, exact_percentile


def shuffled_records(spark) -> int:
    """Rows that all stages of this session have written for a shuffle so far."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(
        None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(n).shuffleWriteRecords() for n in range(stages.size()))


def one(spark, values, fraction, bin_width=1.0, kind="double"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    found = exact_percentile(rows, [], "v", fraction, bin_width).collect()
    return found[0]["percentile"] if found else None


@pytest.mark.parametrize("fraction", [0.0, 0.37, 0.5, 0.9, 1.0])
def test_values_over_many_magnitudes(spark, fraction):
    rng = random.Random(6)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 9) for _ in range(500)] + [0.0, -0.0, 1e15, -1e15]
    got, want = one(spark, values, fraction), np.percentile(values, fraction * 100)
    assert got == pytest.approx(want, rel=1e-12)


def test_ends_of_the_number_range(spark):
    assert one(spark, [-1.7e308, 1.7e308, 0.0], 0.5) == 0.0
    assert one(spark, [5e-324, 1e-323, 0.0], 0.5) == 5e-324
    assert one(spark, [-math.inf, 1.0, 2.0, 3.0, math.inf], 0.5) == 2.0
    assert one(spark, [1.0, 2.0, math.nan], 0.5) == 2.0 and math.isnan(one(spark, [1.0, math.nan], 1.0))


def test_ties_nulls_and_nothing(spark):
    assert one(spark, [7.0] * 100 + [None], 0.5) == 7.0
    assert one(spark, [1.0, 1.0, 2.0, 2.0], 0.5) == 1.5
    assert one(spark, [3, 4, 10**17, 10**17 + 1], 0.5, kind="bigint") == pytest.approx((4 + 10**17) / 2)
    assert one(spark, [None], 0.5) is None and one(spark, [], 0.5) is None


def test_no_value_is_shuffled(spark):
    """Two hundred thousand different values in four tasks: bins of each pass, not values, go over the network."""
    rows = spark.range(0, 200_000, 1, 4).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 1e10).alias("v"))
    before = shuffled_records(spark)
    got = exact_percentile(rows, [], "v", 0.1, bin_width=0.5).first()["percentile"]
    shuffled = shuffled_records(spark) - before
    assert got == pytest.approx(np.percentile([r.v for r in rows.collect()], 10), rel=1e-12)
    # Per pass at most the bins of each of four tasks, and the few located ones.
    assert shuffled < 4 * 200 + 4 * PARTS
