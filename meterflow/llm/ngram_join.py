"""Documents whose sets of word shingles are nearly equal: a size-aware heavy-light join.

Sets are light up to a size bound and heavy beyond it.

* **Light with light.** Two sets of sizes n and m link if they share a subset of at least
  ``needed(n, m)`` shingles. A light set lists its subsets that lack up to the number of shingles
  a link may cost it. All sets of a subset's list that link there also link to the smallest one
  of the list, so one aggregate per subset gives all links, up to connectivity, without pairs.
* **Heavy.** Every set that can link to a heavy one is in the inverted lists of its first shingles
  in a common order, rarest first; two that link share one there, at places that leave room
  for the needed overlap. A list is scanned against its member with the earliest place, then members
  that are still in different groups against each other; pairs whose parity bits leave room for the overlap
  are computed on whole sets.

The bound is chosen by cost: per size the subsets to enumerate against the list entries to scan, both counted.
Equal sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.buckets import grouped
from meterflow.llm.shared import map_texts, parts, staged, text_bytes, with_key
from meterflow.llm.word_hash import mixed, shingle_sets
from meterflow.llm.word_sets import may_overlap, may_share, parities, similar_pairs

PERCENT = 90
# Sets up to this size may be light: beyond it the subsets of one set run into the tens of thousands.
MOST_LIGHT = 39
# Cells of the frequency sketch that orders shingles: one byte each on the driver and in every task.
CELLS = 1 << 20
BLOCK = 1 << 14


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Shared elements two sets of sizes ``n`` and ``m`` need: percent of the union or more."""
    return -(-percent * (n + m) // (100 + percent))


def spare(n: int, percent: int = PERCENT) -> int:
    """Elements of a set of size ``n`` that a linked set may lack."""
    return n - -(-percent * n // 100)


def subsets(n: int, percent: int = PERCENT) -> int:
    """How many subsets a light set of size ``n`` lists."""
    total, ways = 0, 1
    for k in range(spare(n, percent) + 1):
        total += ways
        ways = ways * (n - k) // (k + 1)
    return total


# ---- order of the shingles -------------------------------------------------------------------

def frequencies(docs: DataFrame, shingle: int) -> np.ndarray:
    """For each hash cell a number that rises with the documents that hold its shingles.

    Counted over all documents; per task and block only the cells that are not zero are shuffled. The
    result is a quarter of a power of two in a byte. It only orders shingles: any order
    gives the same links, a better one shorter lists.
    """
    texts = docs.select(text_bytes().alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in chain.from_iterable(map(parts, batches)):
            for own in shingle_sets(batch.column("_text").to_pylist(), shingle):
                np.add.at(cells, own & np.uint64(CELLS - 1), np.uint32(1))
        for block in range(CELLS // BLOCK):
            part = cells[block * BLOCK: (block + 1) * BLOCK]
            held = np.flatnonzero(part)
            if len(held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([held.astype("<u2").tobytes()]),
                     pa.array([part[held].astype("<u4").tobytes()])], names=["block", "cells", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells, counts in zip(*(column.to_pylist() for column in batch.columns)):
                whole = total.setdefault(block, np.zeros(BLOCK, np.uint64))
                whole[np.frombuffer(cells, "<u2")] += np.frombuffer(counts, "<u4")
        for block, whole in total.items():
            levels = np.minimum(np.floor(4 * np.log2(1.0 + whole)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([levels.tobytes()])], names=["block", "levels"])

    summed = texts.mapInArrow(count, "block int, cells binary, counts binary").repartition(
        CELLS // BLOCK, "block").mapInArrow(add, "block int, levels binary")
    order = np.zeros(CELLS, np.uint8)
    for row in summed.collect():  # CELLS bytes in all
        order[row.block * BLOCK: (row.block + 1) * BLOCK] = np.frombuffer(row.levels, np.uint8)
    return order


# ---- sets ------------------------------------------------------------------------------------

def _marked(keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per document its set's size ``n``, digest ``node`` (null without words), first shingles
    ``keys`` in the common order, its ``odd`` cells and the ``whole`` set if it may be light."""
    order = frequencies(keyed, shingle)

    def of_batch(texts: list[bytes]):
        for own in shingle_sets(texts, shingle):
            if not len(own):
                yield 0, None, None, None, None
                continue
            level = order[own & np.uint64(CELLS - 1)]
            first = own[np.argsort(level, kind="stable")[: spare(len(own), percent) + 1]]
            yield (len(own), xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63), first.view(np.int64),
                   parities(own), own.view(np.int64) if len(own) <= MOST_LIGHT else None)

    return staged(map_texts(
        keyed, ["doc_id", "_doc", "_digest"],
        "n long, node long, keys array<bigint>, odd array<bigint>, whole array<bigint>", of_batch), "sets")


def _light_bound(classes: DataFrame, lists: DataFrame, percent: int) -> int:
    """The size up to which listing subsets costs less than scanning inverted lists.

    ``lists`` has the lengths of the lists with more than one member. At most ``MOST_LIGHT`` rows
    reach the driver.
    """
    sizes = classes.where(F.col("n") <= MOST_LIGHT)
    entries = sizes.select("n", F.explode("keys").alias("key")).join(
        lists.select("key", F.col("n").alias("length")), "key").groupBy("n").agg(
        F.sum("length").alias("entries"))
    known = {row.n: (row.sets, row.entries or 0) for row in
             sizes.groupBy("n").agg(F.count("*").alias("sets")).join(entries, "n", "left").collect()}
    best, bound, saved = 0, 0, 0
    for n in range(1, MOST_LIGHT + 1):
        sets, scanned = known.get(n, (0, 0))
        saved += scanned + sets * (spare(n, percent) + 1) - sets * subsets(n, percent)
        if saved >= best:
            best, bound = saved, n
    return bound


# ---- light sets ------------------------------------------------------------------------------

def _light_links(light: DataFrame, percent: int) -> DataFrame:
    """``u`` and ``v``: links between light sets that connect all that link.

    The hash of a subset is the sum of its elements' hashes, so a subset costs one subtraction.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, whole in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "whole"))):
                parts = mixed(np.array(whole, np.int64).view(np.uint64))
                total = parts.sum(dtype=np.uint64)
                keys = [np.array([total], np.uint64)]
                sizes = [np.array([n])]
                for lack in range(1, spare(n, percent) + 1):
                    left_out = parts[np.array(list(combinations(range(n), lack)))]
                    keys.append(total - left_out.sum(axis=1, dtype=np.uint64))
                    sizes.append(np.full(len(left_out), n - lack))
                key = np.concatenate(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), node)), pa.array(np.full(len(key), n, np.int32)),
                     pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(key)],
                    names=["node", "n", "size", "key"])

    listed = staged(light.select("node", "n", "whole").mapInArrow(
        run, "node long, n int, size int, key long"), "subsets")
    smallest = staged(listed.groupBy("size", "key").agg(
        F.min(F.struct("n", "node")).alias("low"), F.count("*").alias("members")).where("members > 1"), "smallest")
    fits = (100 + percent) * F.col("size") >= percent * (F.col("n") + F.col("low.n"))
    return listed.join(smallest, ["size", "key"]).where(fits & (F.col("node") != F.col("low.node"))).select(
        F.col("low.node").alias("u"), F.col("node").alias("v")).distinct()


# ---- heavy sets ------------------------------------------------------------------------------

def _heavy_groups(
    keyed: DataFrame, classes: DataFrame, lists: DataFrame, light_links: DataFrame, bound: int,
    shingle: int, percent: int,
) -> DataFrame:
    """``node`` and ``root`` of all classes with a link."""
    # A list entry's sign is one number: the size, and the elements from the shared one on.
    low = (1 << 32) - 1
    size, rest = lambda sign: F.shiftright(sign, 32), lambda sign: sign.bitwiseAND(F.lit(low))
    members = classes.where(F.col("n") * 100 >= (bound + 1) * percent).select(
        "node", "n", F.posexplode("keys").alias("place", "key")).select(
        "node", "key", F.shiftleft("n", 32).bitwiseOR(F.col("n") - F.col("place")).alias("sign"))

    def may(a: Column, b: Column) -> Column:
        n, m = size(a), size(b)
        return (F.greatest(n, m) > bound) & may_overlap(n, m, percent) & (
            (100 + percent) * F.least(rest(a), rest(b)) >= percent * (n + m))

    def alike(pairs: DataFrame) -> DataFrame:
        # A bit or two per element turn most other pairs away before any text is read again.
        close = pairs
        for side, n, odd in (("u", "_n", "_a"), ("v", "_m", "_b")):
            close = close.join(classes.select(
                F.col("node").alias(side), F.col("n").alias(n), F.col("odd").alias(odd)), side)
        close = staged(close.where(may_share(*map(F.col, ("_a", "_b", "_n", "_m")), percent)).select("u", "v"), "close")
        return similar_pairs(close, classes, keyed, shingle, percent)

    return grouped(members, may, alike, light_links, lists, lambda sign: size(sign) - rest(sign))


def components(docs: DataFrame, shingle: int = 3, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``: the smallest doc_id its links reach.

    Two documents link if their sets of shingles share ``percent`` of their union or more. A text with
    fewer words than a shingle has one element, its word sequence. Null and empty texts and texts without
    words have an empty set and link with nothing, not even with each other: their component_id is their own
    doc_id. A null doc_id is never chosen while another exists; repeated rows stay, one result each.
    No input rows give no result rows. Texts are read whole, a long one in slices.
    """
    keyed = with_key(docs.select("doc_id", "text"))
    marked = _marked(keyed, shingle, percent)
    classes = staged(marked.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("_doc", "_digest")).alias("first"),
        F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("odd").alias("odd"),
        F.first("whole").alias("whole")), "classes")
    lists = staged(classes.select(F.explode("keys").alias("key")).groupBy("key").agg(
        F.count("*").alias("n")).where("n > 1"), "lists")
    bound = _light_bound(classes, lists, percent)
    light = staged(_light_links(classes.where(F.col("n") <= bound), percent), "light")
    roots = _heavy_groups(keyed, classes, lists, light, bound, shingle, percent)
    rooted = classes.select("node", "first_id").join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(rooted.join(lowest, "root").select("node", "component_id"), "components")
    # Both sides are plain scans: adaptive execution splits a class that many copies share.
    return marked.where("node IS NOT NULL").join(named, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").union(
        marked.where("node IS NULL").select("doc_id", "n", "doc_id"))
