"""Connected groups of items that share a key and pass a check, complete for buckets of any size.

Small buckets are paired. Members of crowded ones are first compared with one of them, the one
with the earliest place; then, in buckets that more than one group reaches, members of different
groups are paired in slices spread over tasks. Members of one group need no pair: they are
connected already. So each pair that shares a key is compared or known to be connected, and a large group
of copies costs one comparison per member, not one per pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.components import connected
from meterflow.llm.shared import staged
from meterflow.operators.skew import broadcast_if_small

PAIRED_BUCKET = 32
SLICE = 64


def grouped(
    members: DataFrame, may: Callable[[Column, Column], Column],
    alike: Callable[[DataFrame], DataFrame], known: DataFrame | None = None,
    buckets: DataFrame | None = None, place: Callable[[Column], Column] | None = None,
    paired: DataFrame | None = None,
) -> DataFrame:
    """``node`` and ``root`` of all nodes with a link.

    ``members`` has ``node``, ``key`` and ``sign``, one row per node and key. ``may`` tells from two
    signs whether two nodes can be alike at all; ``alike`` keeps of the pairs ``u`` < ``v`` those that are.
    ``known`` are links found otherwise. ``buckets`` are the keys with more than one member and their number
    ``n``, if counted before. The member of a crowded bucket whose sign has the smallest ``place`` is the one the others
    are compared with first. Where ``paired`` gives the pairs of small buckets, found otherwise, ``members`` are those of
    crowded ones alone.

    All members are shuffled by key, at every size alike, so they should be narrow: a sign is best a number.
    """
    pairs, large = paired, members
    if paired is None:
        if buckets is None:
            buckets = staged(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
        shared = staged(members.join(buckets, "key"), "shared")
        small = shared.where(F.col("n") <= PAIRED_BUCKET)
        left = small.select("key", F.col("node").alias("u"), F.col("sign").alias("a"))
        right = small.select("key", F.col("node").alias("v"), F.col("sign").alias("b"))
        pairs = left.join(right, "key").where(
            (F.col("u") < F.col("v")) & may(F.col("a"), F.col("b"))).select("u", "v")
        large = shared.where(F.col("n") > PAIRED_BUCKET)
    first = F.lit(0) if place is None else place(F.col("sign"))
    centres = staged(large.groupBy("key").agg(
        F.min(F.struct(first.alias("place"), "node", "sign")).alias("centre")), "centres")
    stars = large.join(broadcast_if_small(centres), "key").where(
        (F.col("node") != F.col("centre.node")) & may(F.col("sign"), F.col("centre.sign"))).select(
        F.least("node", "centre.node").alias("u"), F.greatest("node", "centre.node").alias("v"))
    links = staged(alike(staged(pairs.union(stars).distinct(), "pairs")), "links")
    if known is not None:
        links = links.union(known)
    roots = staged(connected(links), "roots")
    more = staged(_across(large, roots, may), "across")
    if more.isEmpty():
        return roots
    return connected(links.union(staged(alike(more), "more")))


def _across(
    large: DataFrame, roots: DataFrame, may: Callable[[Column, Column], Column],
) -> DataFrame:
    """Pairs within crowded buckets whose members are in different groups so far."""
    rooted = staged(
        large.select("key", "node", "sign").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")), "rooted")
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    # The largest group of a bucket is compared with the others, never with itself.
    open_ = sizes.groupBy("key").agg(
        F.count("*").alias("groups"), F.sum("n").alias("n"),
        F.max(F.struct("n", "root")).alias("main")).where("groups > 1").select(
        "key", F.col("main.root").alias("main"), F.ceil(F.col("n") / SLICE).alias("slices"),
        F.ceil((F.col("n") - F.col("main.n")) / SLICE).alias("out_slices"))
    rest = staged(rooted.join(broadcast_if_small(staged(open_, "open")), "key"), "rest")
    place = F.xxhash64("node")
    out = rest.where("root != main").select(
        "key", "main", F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("sign").alias("a"),
        F.pmod(place, "out_slices").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("j"))
    every = rest.select(
        "key", F.col("node").alias("y"), F.col("root").alias("y_root"), F.col("sign").alias("b"),
        F.pmod(place, "slices").alias("j"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_slices") - 1)).alias("i"))
    return out.join(every, ["key", "i", "j"]).where(
        (F.col("x_root") != F.col("y_root")) & ((F.col("y_root") == F.col("main")) | (F.col("x") < F.col("y")))
        & may(F.col("a"), F.col("b"))).select(
        F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()
