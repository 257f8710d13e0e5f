"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

Documents with equal fingerprints form a class. Fingerprints are cut into blocks so that any pair
within the distance agrees on some blocks; classes are joined on those, the Hamming distance is
verified, and connected components are found on the classes. Copies are never paired with
each other.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.buckets import grouped
from meterflow.llm.components import connected
from meterflow.llm.pigeonhole import close_pairs, hamming
from meterflow.llm.shared import map_texts, named, staged, with_key
from meterflow.llm.word_hash import K1, mixed, shingle_sets
from meterflow.llm.word_sets import may_overlap, similar_pairs

CHUNK = 1 << 16


def shingle_hashes(data: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``shingle`` words of an A-Z lower-cased text.

    Fewer words than that are one shingle; no word gives none.
    """
    words = data.lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array(
        [xxhash.xxh64_intdigest(joined[a:b], 42)
         for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
        np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at: at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3) -> DataFrame:
    """The kept columns and ``fp``, one row per document; a text without words has 0."""

    def of_batch(texts: list[bytes]):
        for data in texts:
            yield (fingerprint(shingle_hashes(data, shingle)),)

    return map_texts(docs, keep, "fp long", of_batch)


def components(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the smallest doc_id its links reach.

    Null and empty texts share the fingerprint 0 and link like any other. A null doc_id is never
    chosen as component_id while another exists; repeated rows stay, one result each. No
    input rows give no result rows.
    """
    marked = staged(fingerprints(docs, ["doc_id"], shingle), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = connected(close_pairs(classes.select("fp"), distance))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(rooted.join(lowest, "root").select("fp", "component_id"), "components")
    # Both sides are plain scans: adaptive execution splits a fingerprint that many copies share.
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


# ---- near copies with many small changes: wide fingerprints ----

LANES = 16
# Blocks are cut from some of the lanes: so many lanes, blocks of a lane, and bits of a block.
KEYED_LANES, LANE_BLOCKS, BLOCK_BITS = 12, 5, 12
# By byte value, its eight bits as the eight bytes of a word: adding such words counts all bits at
# once, and a byte can count 255 rows.
SPREAD = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
COUNTED = 255


def lane_words(hashes: np.ndarray) -> np.ndarray:
    """``LANES`` further 64-bit hashes of each hash, a row of them each."""
    return mixed(hashes[:, None] + K1 * np.arange(1, LANES + 1, dtype=np.uint64))


def wide_fingerprint(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of ``LANES`` words, and the smallest hash of each lane; the hashes are distinct."""
    ones, least = np.zeros(LANES * 64, np.int64), np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), COUNTED):
        words = lane_words(hashes[at: at + COUNTED])
        least = np.minimum(least, words.min(axis=0))
        ones += np.add.reduce(SPREAD[words.view(np.uint8)], axis=0).view(np.uint8)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<u8"), least


def block_keys(words: np.ndarray, least: np.ndarray) -> np.ndarray:
    """A key for each block of a fingerprint: its place, its bits and the smallest hash of its lane.

    The smallest hash keeps fingerprints that share the few bits of a block by chance apart, however many there are.
    """
    shifts = np.arange(LANE_BLOCKS, dtype=np.uint64) * np.uint64(BLOCK_BITS)
    blocks = (words[:KEYED_LANES, None] >> shifts) & np.uint64((1 << BLOCK_BITS) - 1)
    places = np.arange(blocks.size, dtype=np.uint64).reshape(blocks.shape) << np.uint64(32)
    return mixed(least[:KEYED_LANES, None] + (blocks + places) * K1).ravel()


def most_distance(similarity: float) -> int:
    """Differing bits that fingerprints of sets of a Jaccard similarity hardly exceed: three deviations over the mean."""
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    bits = LANES * 64
    return int(bits * share + 3 * np.sqrt(bits * share * (1 - share)))


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``_doc``, ``_digest``, ``node`` and ``root``: documents and the group of their shingle set.

    Linked are documents whose sets of shingles share ``percent`` of their union, as far as their
    fingerprints share a block: 998 of 1,000 pairs at a similarity of 0.8, practically all from
    0.85 on. Hamming distance and sizes are checked on the fingerprints, the similarity
    on the whole sets. Documents without words have one set.
    """
    keyed = with_key(docs)

    def of_batch(texts: list[bytes]):
        for own in shingle_sets(texts, shingle):
            words, least = wide_fingerprint(own)
            yield (xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63), len(own), words.view(np.int64),
                   block_keys(words, least).view(np.int64))

    marked = staged(map_texts(
        keyed, ["_doc", "_digest"], "node long, n long, words array<bigint>, keys array<bigint>", of_batch), "marked")
    classes = staged(marked.groupBy("node").agg(
        F.min(F.struct("_doc", "_digest")).alias("first"), F.first("n").alias("n"),
        F.first("words").alias("words"), F.first("keys").alias("keys")), "classes")

    def may(a: Column, b: Column) -> Column:
        return may_overlap(a, b, percent)

    def alike(pairs: DataFrame) -> DataFrame:
        close = pairs
        for side, name in (("u", "_left"), ("v", "_right")):
            close = close.join(classes.select(F.col("node").alias(side), F.col("words").alias(name)), side)
        differing = F.aggregate(
            F.zip_with("_left", "_right", hamming), F.lit(0), lambda total, bits: total + bits)
        close = staged(close.where(differing <= most_distance(percent / 100)).select("u", "v"), "close")
        return similar_pairs(close, classes, keyed, shingle, percent)

    members = classes.where("n > 0").select("node", F.col("n").alias("sign"), F.explode("keys").alias("key"))
    roots = grouped(members, may, alike)
    return marked.select("_doc", "_digest", "node").join(roots, "node", "left").select(
        "_doc", "_digest", "node", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, that come first in their group; of repeated rows one stays.

    First is the smallest doc_id, null behind all others, then the smallest digest of the text.
    """
    keepers = staged(
        near_groups(docs, shingle, percent).groupBy("root")
        .agg(F.min(F.struct("_doc", "_digest")).alias("first")).select("first.*"), "keepers")
    return with_key(docs).join(keepers, ["_doc", "_digest"], "left_semi").dropDuplicates(
        ["_doc", "_digest"]).select(*named(docs.columns))
