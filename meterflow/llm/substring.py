"""Removal of word sequences that occurred before, by level-wise doubling of repeated windows.

The first level looks at short windows, and of those only at the anchors: the smallest hash inside
every run of twice that length. Equal runs have equal anchors, so a run whose anchor occurs only
once cannot be repeated. Windows around repeated anchors are candidates of twice the length;
windows both of whose halves are repeated are candidates of the next level, until the wanted
length is reached or nothing is left.

No level joins on a hash: a hash is aggregated with map-side combine to its count and its smallest
document, and one row per hash goes back to that document - the unique windows, which end there,
and on the last level the first ones, which stay. What a document listed and does not get back is
repeated elsewhere. A passage that a third of all documents share is thus one buffer per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterflow.llm.word_hash import grouped_words

WINDOW = 20
BASE = 10
# Odd multipliers of the mixing step.
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
OTHER = np.uint64(0xA5A5A5A5A5A5A5A5)


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two adjoining windows from the hashes of both."""
    mixed = left * K1 + (right ^ (right >> np.uint64(31))) * K2
    mixed ^= mixed >> np.uint64(29)
    mixed *= K3
    return mixed ^ (mixed >> np.uint64(32))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words."""
    if len(hashes) < length:
        return hashes[:0]
    if length == 1:
        return hashes
    half = length // 2
    level = window_hashes(hashes, half)
    count = len(hashes) - length + 1
    joined = join_hashes(level[:count], level[half: half + count])
    return joined if length % 2 == 0 else join_hashes(joined, hashes[length - 1:])


def anchors(hashes: np.ndarray, base: int) -> np.ndarray:
    """For each run of ``2 * base`` words, the place of its anchor: the leftmost smallest window hash."""
    if len(hashes) < 2 * base:
        return np.empty(0, np.int64)
    values = window_hashes(hashes, base)
    places, width = np.arange(len(values)), 1
    while width <= base:
        # Two overlapping stretches make one of up to twice the width.
        step = min(width, base + 1 - width)
        left, right = values[:-step], values[step:]
        take = left <= right
        places = np.where(take, places[:-step], places[step:])
        values = np.minimum(left, right)
        width += step
    return places


def alive_windows(
    hashes: np.ndarray, base: int, ended: dict[int, np.ndarray], length: int,
) -> np.ndarray:
    """Places of the windows of ``length`` words still in play, given the hashes that ended."""
    at = anchors(hashes, base)
    if not len(at):
        return at
    # Neighbouring runs share their anchor: each is looked up once.
    open_ = np.zeros(len(hashes), bool)
    open_[at] = True
    spots = np.flatnonzero(open_)
    open_[spots] = ~np.isin(window_hashes(hashes, base)[spots], ended[base])
    alive = open_[at]
    level = 2 * base
    while level < length and alive.any():
        places = np.flatnonzero(alive)
        alive[places] = ~np.isin(window_hashes(hashes, level)[places], ended[level])
        count = max(0, len(hashes) - 2 * level + 1)
        alive = alive[:count] & alive[level: level + count]
        level *= 2
    # All ended at a lower level: no window is left.
    return np.flatnonzero(alive)


def removed_words(
    hashes: np.ndarray, base: int, window: int, ended: dict[int, np.ndarray],
) -> np.ndarray:
    """Words covered by a repeated window that is not the first of its kind."""
    out = np.zeros(len(hashes) + 1, np.int64)
    places = alive_windows(hashes, base, ended, window)
    if len(places):
        values, first = np.unique(window_hashes(hashes, window)[places], return_index=True)
        stays = np.zeros(len(places), bool)
        stays[first] = np.isin(values, ended[window])
        places = places[~stays]
        np.add.at(out, places, 1)
        np.add.at(out, places + window, -1)
    return np.cumsum(out[:-1]) > 0


def _hashed(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Place of each text and the hashes of its words."""
    for first, _, _, hashes, _, _, begins in grouped_words(texts):
        for place, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist()), first):
            yield place, hashes[a:b]


def _keyed(docs: DataFrame) -> DataFrame:
    """``_doc`` orders documents: by id, and behind those by a digest where the id is null."""
    text = F.coalesce(F.col("text"), F.lit(""))
    behind = F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), behind).alias("_doc"),
        F.col("doc_id"), text.cast("binary").alias("_text"))


LISTED = "_hash long, _check int, _times int, _doc long"


def _listed_rows(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    """Rows of ``LISTED`` from (place, hashes, checks) per text: a row per distinct hash."""
    owners, values, checks, times = [], [], [], []
    for place, hashes, check in found:
        value, first, count = np.unique(hashes, return_index=True, return_counts=True)
        owners.append(np.full(len(value), place))
        values.append(value)
        checks.append(check[first])
        times.append(count)

    def whole(parts, kind):
        return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)

    return pa.RecordBatch.from_arrays(
        [pa.array(whole(values, np.uint64).view(np.int64)), pa.array(whole(checks, np.int32)),
         pa.array(whole(times, np.int32)),
         batch.column("_doc").take(pa.array(whole(owners, np.int64)))],
        ["_hash", "_check", "_times", "_doc"])


def _first_level(keyed: DataFrame, base: int) -> DataFrame:
    """The anchors of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for place, hashes in _hashed(batch.column("_text").to_pylist()):
                held = np.zeros(len(hashes), bool)
                held[anchors(hashes, base)] = True
                spots = np.flatnonzero(held)
                if len(spots):
                    found.append((
                        place, window_hashes(hashes, base)[spots], np.zeros(len(spots), np.int32)))
            yield _listed_rows(batch, found)

    return keyed.select("_doc", "_text").mapInArrow(run, LISTED)


def _ended(batch: pa.RecordBatch, lists: dict[int, str]) -> list[dict[int, np.ndarray]]:
    """Per row of the batch, by level, the hashes that came back."""
    return [
        {level: cell.values.to_numpy().view(np.uint64)
         if (cell := batch.column(name)[row]).is_valid else np.empty(0, np.uint64)
         for level, name in lists.items()}
        for row in range(batch.num_rows)]


def _next_level(listed: DataFrame, base: int, length: int, lists: dict[int, str]) -> DataFrame:
    """Candidate windows of ``length`` words; the check widens the hash to 95 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ended, found = _ended(batch, lists), []
            for place, hashes in _hashed(batch.column("_text").to_pylist()):
                spots = alive_windows(hashes, base, ended[place], length)
                if len(spots):
                    other = window_hashes(join_hashes(hashes, hashes ^ OTHER), length)[spots]
                    found.append((
                        place, window_hashes(hashes, length)[spots],
                        (other >> np.uint64(33)).astype(np.int32)))
            yield _listed_rows(batch, found)

    # All columns go in: the documents are then shuffled once, for this step and for the last.
    return listed.mapInArrow(run, LISTED)


def _going_back(listed: DataFrame, last: bool, name: str) -> DataFrame:
    """Per document, the hashes that end with it: unique ones, on the last level first ones."""
    per_hash = listed.groupBy("_hash", "_check").agg(
        F.sum("_times").alias("_n"), F.min("_doc").alias("_doc"))
    if not last:
        per_hash = per_hash.where("_n = 1")
    return per_hash.groupBy("_doc").agg(F.collect_list("_hash").alias(name))


def _strip(
    listed: DataFrame, base: int, window: int, lists: dict[int, str], with_text: bool,
) -> DataFrame:
    made = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    extra = ", removed array<struct<start:int,end:int>>, kept_text string" if with_text else ""
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
             *([("removed", spans), ("kept_text", pa.string())] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ended, found = _ended(batch, lists), [()] * batch.num_rows
            texts = batch.column("_text").to_pylist()
            for place, hashes in _hashed(texts):
                out, words = removed_words(hashes, base, window, ended[place]), texts[place].split()
                kept = [word for word, dead in zip(words, out.tolist()) if not dead] \
                    if out.any() else words
                joined = b" ".join(kept)
                found[place] = (len(words), int(out.sum()), hashlib.sha256(joined).hexdigest())
                if with_text:
                    bounds = np.flatnonzero(np.diff(np.concatenate(([0], out.view(np.int8), [0]))))
                    found[place] += (
                        [{"start": a, "end": b} for a, b in bounds.reshape(-1, 2).tolist()],
                        joined.decode("utf-8", "replace"))
            columns = list(zip(*found)) if found else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64())]
                + [pa.array(values, kind) for values, (_, kind) in zip(columns, kinds)],
                ["doc_id", *[name for name, _ in kinds]])

    return listed.mapInArrow(run, made + extra)


def dedup(
    docs: DataFrame, window: int = WINDOW, base: int = BASE, with_text: bool = True,
) -> DataFrame:
    """One row per input row: word counts, the digest of the kept words, and the kept text.

    ``removed`` holds word ranges (end exclusive), ``kept_text`` the kept words joined by a space;
    both only ``with_text``. ``window`` must be ``base`` doubled once or more. A null text has no
    words. A window is removed because of a smaller doc_id or an earlier start in its own text;
    rows that share a doc_id - repeated rows too - do not touch each other. Null ids sort
    behind all others, in the order of a digest of their text. No input rows, no result rows.
    """
    lengths = [2 * base]
    while lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    if lengths[-1] != window:
        raise ValueError("the window must be the base length times a power of two")
    keyed = _keyed(docs)
    lists = {base: f"_ended{base}"}
    listed = keyed.join(
        _going_back(_first_level(keyed, base), False, lists[base]), "_doc", "left")
    for length in lengths:
        found = _next_level(listed, base, length, lists)
        lists = lists | {length: f"_ended{length}"}
        listed = listed.join(
            _going_back(found, length == window, lists[length]), "_doc", "left")
    return _strip(listed, base, window, lists, with_text)
