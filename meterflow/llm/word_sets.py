"""Overlap of the word-shingle sets of pairs of documents, computed from the whole texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.shared import map_texts, staged
from meterflow.llm.word_hash import shingle_sets
from meterflow.operators.skew import broadcast_if_small


def may_overlap(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of two sizes can share ``percent`` of their union."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def parities(own: np.ndarray) -> np.ndarray:
    """For each of at least as many cells as there are elements, whether it holds an odd number of them.

    One bit a cell, cells are the low bits of the hashes and a power of two: parities of half as many cells are
    those of both halves xored.
    """
    cells = 1 << max(6, int(len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def may_share(a: Column, b: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets with parities ``a`` and ``b`` and sizes ``n`` and ``m`` can share ``percent`` of their union.

    An element that is in one of two sets alone changes one cell, so the cells that differ are never more than such
    elements: no pair that shares enough is turned away. Sizes are within a factor of two.
    """
    def folded(long: Column, short: Column) -> Column:
        half = F.size(short)
        return F.when(F.size(long) > half, F.zip_with(
            F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(long)

    differing = F.aggregate(
        F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("bigint")),
        F.lit(0).cast("bigint"), lambda total, bits: total + bits)
    return (100 + percent) * differing <= (100 - percent) * (n + m)


def similar_pairs(
    pairs: DataFrame, classes: DataFrame, keyed: DataFrame, shingle: int, percent: int,
) -> DataFrame:
    """The pairs ``u``, ``v`` of classes whose sets share ``percent`` of their union or more.

    ``classes`` has ``node`` and ``first``, the ``_doc`` and ``_digest`` of a document of the class in
    ``keyed``. Only the texts of classes in a pair are read again; no set is kept for others.
    """
    involved = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    held = staged(classes.select("node", "first").join(involved, "node"), "held")
    docs = keyed.select("_doc", "_digest", "text").join(
        broadcast_if_small(held.select("first.*", "node")), ["_doc", "_digest"])

    def of_batch(texts: list[bytes]):
        for own in shingle_sets(texts, shingle):
            yield (own.view(np.int64),)

    sets = staged(map_texts(docs, ["node"], "shingles array<bigint>", of_batch).dropDuplicates(["node"]), "shingles")
    for side, name in (("u", "_left"), ("v", "_right")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(name)), side)
    both = F.size(F.array_intersect("_left", "_right"))
    return pairs.where(
        (100 + percent) * both >= percent * (F.size("_left") + F.size("_right"))).select("u", "v")
