"""All pairs of distinct 64-bit fingerprints within a Hamming distance of two, up to connectivity.

With ``blocks`` blocks, two fingerprints that differ in ``d`` bits agree on all but ``d`` of them,
so joining on every choice of ``blocks - d`` blocks misses no pair. Buckets with few members are
paired and verified. A bucket with many members - variants of one text - would give a square
number of pairs; there each fingerprint is also listed under every fingerprint one bit away from
it. Two at distance two have such a middle in common, a middle has at most 65 members, and all of
them are within two bits of each other: each is linked to the smallest. The links differ from
all pairs only in leaving out links between members that are connected anyway.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.shared import staged

BITS = 64
SMALL_BUCKET = 32


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def block_masks(blocks: int, distance: int) -> list[int]:
    """One mask for every choice of blocks that a close pair may agree on."""
    edges = [round(BITS * n / blocks) for n in range(blocks + 1)]
    each = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [signed(sum(chosen)) for chosen in combinations(each, blocks - distance)]


def hamming(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))


def close_pairs(fps: DataFrame, distance: int = 2, blocks: int = 4) -> DataFrame:
    """``u`` < ``v``: links between distinct values of column ``fp``."""
    if not 1 <= distance <= 2:
        raise ValueError("the exact way for large buckets is made for distances 1 and 2")
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("part"))
        for n, mask in enumerate(block_masks(blocks, distance))])).alias("key")).select(
        "fp", "key.choice", "key.part")
    buckets = staged(
        keyed.groupBy("choice", "part")
        .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("n > 1"), "buckets")
    # Most shared buckets hold one pair, which the aggregate already names.
    twos = buckets.where("n = 2").select(F.col("low").alias("u"), F.col("high").alias("v"))
    shared = staged(
        keyed.join(buckets.where("n > 2").select("choice", "part", "n"), ["choice", "part"]),
        "shared")
    small = shared.where(F.col("n") <= SMALL_BUCKET)
    paired = small.select("choice", "part", F.col("fp").alias("u")).join(
        small.select("choice", "part", F.col("fp").alias("v")), ["choice", "part"]).where("u < v")
    hot = shared.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    flipped = F.transform(
        F.array(*[F.lit(signed(1 << bit)) for bit in range(BITS)]),
        lambda bit: F.col("fp").bitwiseXOR(bit))
    middles = (
        hot.select("fp", F.explode(F.concat(F.array("fp"), flipped)).alias("middle"))
        .groupBy("middle").agg(F.sort_array(F.collect_set("fp")).alias("near"))
        .where(F.size("near") > 1))
    if distance == 2:
        around = middles.select(
            F.element_at("near", 1).alias("u"),
            F.explode(F.slice("near", 2, BITS + 1)).alias("v"))
    else:
        around = middles.select("middle", F.explode("near").alias("fp")).where("middle != fp") \
            .select(F.least("middle", "fp").alias("u"), F.greatest("middle", "fp").alias("v")) \
            .join(fps.select(F.col("fp").alias("u")), "u", "left_semi") \
            .join(fps.select(F.col("fp").alias("v")), "v", "left_semi").select("u", "v")
    return (
        twos.union(paired.select("u", "v")).union(around)
        .where(hamming(F.col("u"), F.col("v")) <= distance).distinct())
