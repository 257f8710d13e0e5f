"""Crowded buckets: complete, without all pairs of a large group."""

from __future__ import annotations

from meterflow.llm import buckets
from pyspark.sql import functions as F


def test_crowded_bucket_links_members_far_from_the_smallest(spark):
    """Numbers in one bucket; alike are neighbours in pairs, and a hot group of hundreds."""
    values = [10 * n + k for n in range(60) for k in (0, 1)] + [5000] * 1
    values += list(range(100_000, 100_300))
    members = spark.createDataFrame([(v, 1, v) for v in values], "node long, key long, sign long")
    calls = []

    def alike(pairs):
        calls.append(pairs.count())
        return pairs.where("v - u = 1")

    roots = buckets.grouped(members, lambda a, b: F.abs(a - b) <= 3, alike)
    got = {r.node: r.root for r in roots.collect()}
    assert all(got[10 * n + 1] == got[10 * n] == 10 * n for n in range(60))
    assert all(got[n] == 100_000 for n in range(100_000, 100_300)) and 5000 not in got
    assert sum(calls) < 3000
