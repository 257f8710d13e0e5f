"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterflow.llm.shared import staged


def connected(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for every node of ``u``-``v`` links.

    Each half round hangs the neighbours of a node below the smallest of them. Minima are
    aggregates and written before they are joined, so that both sides of the join are plain scans
    and adaptive execution can split the centre of a large star. Rounds end when nothing moves;
    their number grows with the logarithm of the longest chain.
    """
    arcs = staged(
        links.where("u != v").select(
            F.greatest("u", "v").alias("child"), F.least("u", "v").alias("parent")).distinct(),
        "arcs")
    seen = _state(arcs)
    for _ in range(most_rounds):
        arcs = _small_star(_large_star(arcs))
        state = _state(arcs)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    lowest = arcs.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    roots = arcs.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return lowest.union(roots)


def _state(arcs: DataFrame) -> tuple:
    """Count and order-free checksums of the arcs; only these reach the driver."""
    mixed = F.xxhash64("child", "parent")
    return tuple(arcs.agg(
        F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first())


def _large_star(arcs: DataFrame) -> DataFrame:
    both = arcs.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(
        arcs.select(F.col("parent").alias("u"), F.col("child").alias("v")))
    lowest = staged(
        both.groupBy("u").agg(F.min("v").alias("least"))
        .select("u", F.least("u", "least").alias("least")), "lowest")
    return staged(
        both.where("v > u").join(lowest, "u")
        .select(F.col("v").alias("child"), F.col("least").alias("parent")).distinct(), "large")


def _small_star(arcs: DataFrame) -> DataFrame:
    lowest = staged(arcs.groupBy("child").agg(F.min("parent").alias("least")), "lowest")
    moved = arcs.join(lowest, "child").where("parent != least").select(
        F.col("parent").alias("child"), F.col("least").alias("parent"))
    return staged(
        moved.union(lowest.select("child", F.col("least").alias("parent"))).distinct(), "small")
