"""Line dedup across documents: fuzzy lines keep one occurrence per connected group.

Equal normalised lines are one class. An edit touches at most as many runs of q words as q, so two
lines within the bound share a known number of their runs, and hence at least one of the first few
in any fixed order (a prefix). Classes that share such a run are compared by edit similarity in words,
similar ones are linked, and connected groups keep their earliest line. No similar pair is missed.

Keys are most of what is made, and most belong to one line alone. They travel packed, in slices that a
task can sort, with the lines that they come from; only keys met again become rows. Lines that share one are
held against each other by their signs where they meet, and only pairs that may be alike are written.
Only the lines that go return to their documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from meterflow.llm.buckets import PAIRED_BUCKET, grouped
from meterflow.llm.edit import similar
from meterflow.llm.shared import explode_texts, named, parts, staged, text_bytes, with_key
from meterflow.llm.word_hash import K2 as MIX1, K3 as MIX2, grouped_words
from meterflow.operators.skew import broadcast_if_small, fits_broadcast

MIN_WORDS = 5
SIMILARITY = 0.8
# Runs of so many words, the longest first that the edit bound leaves any of.
RUNS = (3, 2, 1)
# How common runs are is counted on one in so many documents, in so many cells. Rare runs come first in
# the order; any order gives the same result.
SAMPLED, RANK_BITS, RANKED = 64, 20, 4
SIGN_BITS = 256
LONGS = [f"s{n}" for n in range(SIGN_BITS // 64)]
# Text whose keys share a slice, and the bytes of a key that tell it from the others there (all but one in
# some thousands; what meets by chance is told apart by its signs).
SLICE_BYTES, KEY_BYTES = 32 << 20, 4
# Members of keys that a task compares, and the most members of a key that it compares with each other.
COMPARED, MOST_COMPARED = 200_000, 1 << 14
# Members compared in one step: few at a time for the many small keys, a square of them for the others.
FEW, ACROSS, DOWN = 64, 256, 1024
# Keys of so common a rank (a million or more, by the sample) are not packed; their lines are spread instead.
HOT_RANK, HOT_SLICES = 15, 1024
# Lists of lines per document are narrow, so that more rows may be broadcast than of others.
LISTS = 1_000_000
# Letters in one case, digits alike, ASCII punctuation as blanks; other bytes stay.
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c if 97 <= c <= 122 or c > 127 else 32
    for c in range(256))
# Characters of scripts without blanks count as words: kana and ideographs, Thai and Lao.
UNSPACED = re.compile(rb"[\xe3-\xe9][\x80-\xbf]{2}|\xf0[\xa0-\xbf][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]")


def normalised(line: bytes) -> bytes:
    """A line as it is compared: one with too few words only as it stands, without blanks around it."""
    spaced = line if line.isascii() else UNSPACED.sub(rb" \g<0> ", line)
    words = spaced.translate(NORMAL).split()
    return b" ".join(words) if len(words) >= MIN_WORDS else line.strip()


def most_edits(length: int, least: float) -> int:
    return int(length * (1 - least) + 1e-9)


@lru_cache(maxsize=1 << 16)
def prefixes(length: int, least: float) -> tuple[tuple[int, int], ...]:
    """``(q, count)``: how many of its first runs of q words a line of ``length`` words needs.

    Over all lengths ``n`` of a longer partner: k edits leave ``n - q + 1 - q * k`` runs in common.
    """
    needed: dict[int, int] = {}
    n = length
    while n - length <= most_edits(n, least):
        k = most_edits(n, least)
        q = next(q for q in RUNS if n - q + 1 - q * k >= 1)
        runs = length - q + 1
        needed[q] = max(needed.get(q, 0), min(runs, runs - (n - q + 1 - q * k) + 1))
        n += 1
    return tuple((q, count) for q, count in needed.items() if count > 0)


def word_runs(words: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` words from each place on."""
    mixed = np.full(len(words), q, np.uint64)
    for ahead in range(q):
        mixed = (mixed ^ np.roll(words, -ahead)) * MIX1
        mixed ^= mixed >> np.uint64(29)
    mixed *= MIX2
    return mixed ^ (mixed >> np.uint64(32))


def _in_parts(lines: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First line, word hashes and lengths of parts of the lines that fit into memory."""
    for begin, _, _, hashes, _, _, begins in grouped_words(lines):
        yield begin, hashes, np.diff(begins)


def line_keys(
    lines: list[bytes], least: float, rank: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all lines behind each other, their number per line, the words of each line and the lines' signs.

    A sign has a bit per cell of word hashes, whether an odd number of words is in it: an edit changes at most
    two bits, an inserted word one. Lines too short to be like any other have no key.
    """
    keys, counts, sizes = [np.empty(0, np.uint64)], np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int32)
    signs = np.zeros((len(lines), SIGN_BITS // 8), np.uint8)
    for begin, words, lengths in _in_parts(lines):
        size = len(lengths)
        sizes[begin:begin + size] = lengths
        owner = np.repeat(np.arange(size), lengths)
        long = np.flatnonzero(lengths >= MIN_WORDS)
        place = np.cumsum(lengths >= MIN_WORDS) - 1
        bits = np.zeros(len(long) * SIGN_BITS, np.uint8)
        of_long = lengths[owner] >= MIN_WORDS
        np.add.at(bits, place[owner[of_long]] * SIGN_BITS + (words[of_long] % np.uint64(SIGN_BITS)).astype(np.int64), 1)
        signs[begin + long] = np.packbits((bits & 1).reshape(-1, SIGN_BITS), axis=1, bitorder="little")
        within = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        made, owners = [], []
        for q in RUNS:
            wanted = np.array([
                dict(prefixes(n, least)).get(q, 0) if n >= MIN_WORDS else 0 for n in lengths.tolist()])
            held = (within + q <= lengths[owner]) & (wanted[owner] > 0)
            if not held.any():
                continue
            of, codes = owner[held], word_runs(words, q)[held]
            order = np.lexsort((codes, rank[codes >> np.uint64(64 - RANK_BITS)], of))
            of, codes = of[order], codes[order]
            per_line = np.bincount(of, minlength=size)
            place = np.arange(len(of)) - (np.cumsum(per_line) - per_line)[of]
            again = np.zeros(len(of), bool)
            again[1:] = (of[1:] == of[:-1]) & (codes[1:] == codes[:-1])
            stays = (place < wanted[of]) & ~again
            made.append(codes[stays])
            owners.append(of[stays])
        if made:
            owner = np.concatenate(owners)
            keys.append(np.concatenate(made)[np.argsort(owner, kind="stable")])
            counts[begin:begin + size] = np.bincount(owner, minlength=size)
    return np.concatenate(keys), counts, sizes, signs


def ranks(keyed: DataFrame) -> np.ndarray:
    """By leading bits of a run's hash, the binary logarithm of its count in a sample of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RANK_BITS, np.int64)
        for batch in batches:
            lines = [normal for data in batch.column("_text").to_pylist()
                     for line in set(data.split(b"\n")) if (normal := normalised(line))]
            for _, words, _ in _in_parts(lines):
                cells = word_runs(words, RUNS[0]) >> np.uint64(64 - RANK_BITS)
                total += np.bincount(cells.astype(np.int64), minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total[cells])], ["cell", "n"])

    counted = (
        keyed.where(F.pmod(F.xxhash64("_digest"), F.lit(SAMPLED)) == 0).select(text_bytes().alias("_text"))
        .mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= RANKED).collect())
    rank = np.zeros(1 << RANK_BITS, np.uint8)
    for row in counted:
        rank[row.cell] = int(row.n).bit_length()
    return rank


def _line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(line) for line in lines], np.uint64).view(np.int64)


def _lines_of_batch(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per comparable line: its text's place, hash and number in the text."""
    owners, numbers, lines = [], [], []
    for place, data in enumerate(texts):
        for number, line in enumerate(data.split(b"\n")):
            if normal := normalised(line):
                owners.append(place)
                numbers.append(number)
                lines.append(normal)
    return np.array(owners, np.int64), _line_hashes(lines), np.array(numbers, np.int32)


def _with_list(keyed: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    """The texts of documents with the ``_list`` of their lines."""
    if fits_broadcast(listed, LISTS):
        listed = F.broadcast(listed)
    return keyed.select("_doc", "_digest", text_bytes().alias("_text")).join(listed, ["_doc", "_digest"], how)


def _planes(values: np.ndarray) -> bytes:
    """Small numbers as four runs of bytes, mostly zero."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _steps(places: np.ndarray) -> bytes:
    """Rising numbers by what each adds to the one before."""
    return _planes(np.diff(places, prepend=0))


def _packed(keyed: DataFrame, again: DataFrame, least: float, rank: np.ndarray, slices: int) -> DataFrame:
    """Keys of the first line of each class by ``slice``: the places of its lines in their batch and words, the keys of each
    and their number. ``batch`` and a place together are a line's number; its hash would be sent with every slice.

    Slices from ``slices`` on hold lines with common keys, those below zero hashes and signs of the lines with any.
    """

    def packs(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = {}
        for data, left_out in zip(batch.column("_text").to_pylist(), batch.column("_list").to_pylist()):
            left_out = set(left_out or ())
            for number, line in enumerate(data.split(b"\n")):
                if number not in left_out and (normal := normalised(line)):
                    lines[normal] = None
        lines = list(lines)
        hashes = _line_hashes(lines)
        keys, counts, sizes, signs = line_keys(lines, least, rank)
        owner = np.repeat(np.arange(len(lines)), counts)
        of = ((keys >> np.uint64(8 * KEY_BYTES)) % np.uint64(slices)).astype(np.int64)
        hot = rank[keys >> np.uint64(64 - RANK_BITS)] >= HOT_RANK
        of[hot] = slices + hashes[owner[hot]] % HOT_SLICES
        order = np.argsort(of, kind="stable")
        of, owner = of[order], owner[order]
        data = keys[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        begins = np.concatenate((np.flatnonzero(np.diff(of, prepend=-1)), [len(of)])).tolist()
        rows, signed = [], np.flatnonzero(counts)
        # From what the batch holds, so that it is the same when a lost task runs again.
        number = xxhash.xxh3_64_intdigest(hashes.tobytes()) >> 2
        if len(signed):
            rows.append((-1 - number % HOT_SLICES, number, _steps(signed), _planes(sizes[signed]),
                         hashes[signed].tobytes(), signs[signed].tobytes()))
        for a, b in zip(begins[:-1], begins[1:]):
            here, held = np.unique(owner[a:b], return_counts=True)
            rows.append((int(of[a]), number, _steps(here), _planes(sizes[here]), _planes(held), data[a:b].tobytes()))
        columns = list(zip(*rows)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             *[pa.array(c, pa.binary()) for c in columns[2:]]],
            ["slice", "batch", "places", "sizes", "held", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(parts, batches)):
            yield packs(batch)

    return _with_list(keyed, again, "left").select("_text", "_list").mapInArrow(
        run, "slice int, batch long, places binary, sizes binary, held binary, keys binary")


def _most(sizes: np.ndarray, least: float) -> np.ndarray:
    """Edits that lines of so many words allow, by the longer of two."""
    return np.floor(sizes * (1 - least) + 1e-9).astype(np.int64)


def _met(packed: DataFrame, least: float, slices: int) -> DataFrame:
    """Members ``line`` of each ``key`` that lines of like length share, with ``n`` words; ``many`` where it has more than a
    task compares. Lines ``line`` with their hash ``node`` and sign, without key."""

    def meet(rows: pa.Table) -> pa.Table:
        column = lambda name: rows.column(name).to_pylist()
        number = np.concatenate([batch + np.cumsum(_from_planes(data)) for batch, data in zip(
            column("batch"), column("places"))])
        size = np.concatenate([_from_planes(data) for data in column("sizes")]).astype(np.int32)
        spread = rows.column("slice")[0].as_py()
        if spread < 0:
            return _met_rows(number, size, node=np.frombuffer(b"".join(column("held")), np.int64),
                             longs=np.frombuffer(b"".join(column("keys")), "<i8").reshape(len(number), -1))
        line = np.repeat(np.arange(len(number)), np.concatenate([_from_planes(data) for data in column("held")]))
        wide = np.zeros((len(line), 8), np.uint8)
        wide[:, :KEY_BYTES] = np.frombuffer(b"".join(column("keys")), np.uint8).reshape(-1, KEY_BYTES)
        key = wide.view("<i8").ravel()
        if spread >= slices:
            # Below zero, apart from the keys of any slice.
            return _met_rows(number[line], size[line], -1 - key, np.ones(len(key), bool))
        order = np.argsort(key)
        key = key[order]
        # Most keys are met once; the rest is worked on without them.
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        again[:-1] |= again[1:]
        line, key = line[order[again]], key[again]
        number, size = number[line], size[line]
        order = np.lexsort((size, key))
        number, size, key = number[order], size[order], key[order]
        # By length: where a line cannot be like the next longer one, no shorter line is like a longer one.
        joins = np.zeros(len(key) + 1, bool)
        joins[1:-1] = (key[1:] == key[:-1]) & (size[:-1] >= size[1:] - _most(size[1:], least))
        begins = np.flatnonzero(~joins[:-1])
        count = np.diff(np.append(begins, len(key)))
        shared, many = np.repeat(count > 1, count), np.repeat(count > MOST_COMPARED, count)
        return _met_rows(number[shared], size[shared], (key | spread << 8 * KEY_BYTES)[shared], many[shared])

    return packed.groupBy("slice").applyInArrow(
        meet, "line long, key long, n int, many boolean, node long, " + ", ".join(f"{name} long" for name in LONGS))


def _met_rows(
    line: np.ndarray, size: np.ndarray, key: np.ndarray | None = None, many: np.ndarray | None = None,
    node: np.ndarray | None = None, longs: np.ndarray | None = None,
) -> pa.Table:
    def column(values: np.ndarray | None, kind: pa.DataType) -> pa.Array:
        return pa.nulls(len(line), kind) if values is None else pa.array(np.ascontiguousarray(values), kind)

    return pa.table({
        "line": column(line, pa.int64()), "key": column(key, pa.int64()), "n": column(size, pa.int32()),
        "many": column(many, pa.bool_()), "node": column(node, pa.int64()),
        **{name: column(None if longs is None else longs[:, at], pa.int64()) for at, name in enumerate(LONGS)}})


def _close(node: np.ndarray, size: np.ndarray, key: np.ndarray, signs: np.ndarray, least: float) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs that share a key and may be alike by length and sign, and of the members of keys with too many.

    Rows are ordered by key and size. A key with more pairs than ``PAIRED_BUCKET`` members have, for its size, is mostly
    one group or few: it is left to be compared with one member first.
    """
    most = _most(size, least)
    shortest, bits = size - most, 2 * most - size
    begins = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    ends = np.append(begins[1:], len(key))
    count = ends - begins
    of = np.repeat(np.arange(len(begins)), count)
    room = count * (PAIRED_BUCKET // 2)
    us, vs, full = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(len(begins), bool)
    few = np.flatnonzero((count <= FEW)[of])
    for ahead in range(1, FEW):
        a, b = few[:-ahead], few[ahead:]
        here = (of[a] == of[b]) & (size[a] >= shortest[b])
        if not here.any():
            break
        a, b = a[here], b[here]
        may = np.bitwise_count(signs[a] ^ signs[b]).sum(axis=1, dtype=np.int64) <= bits[b] + size[a]
        us.append(a[may])
        vs.append(b[may])
    for group in np.flatnonzero(count > FEW):
        end, found = ends[group], 0
        for a in range(begins[group], end, ACROSS):
            b_end = min(a + ACROSS, end)
            for b in range(a, end, DOWN):
                left, right = slice(a, b_end), slice(b, min(b + DOWN, end))
                if shortest[b] > size[b_end - 1]:
                    break
                apart = np.zeros((b_end - a, right.stop - b), np.int64)
                for word in range(signs.shape[1]):
                    apart += np.bitwise_count(signs[left, word][:, None] ^ signs[right, word][None, :])
                may = (apart <= bits[right][None, :] + size[left][:, None]) & (
                    shortest[right][None, :] <= size[left][:, None])
                u, v = np.nonzero(may)
                u, v = u + a, v + b
                u, v = u[u < v], v[u < v]
                us.append(u)
                vs.append(v)
                found += len(u)
            if found > room[group]:
                break
    u, v = np.concatenate(us), np.concatenate(vs)
    full = np.bincount(of[u], minlength=len(begins)) > room
    return u[~full[of[u]]], v[~full[of[u]]], np.flatnonzero(full[of])


def _compared(members: DataFrame, parts: int, least: float) -> DataFrame:
    """Pairs ``u``, ``v`` of members that may be alike; members ``u`` of keys to be compared with one of them first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            many = batch.column("many")
            if many.true_count:
                yield rows(batch.filter(many))
            if many.false_count:
                held.append(batch.filter(pc.invert(many)))
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        node, key, size = (whole.column(name).to_numpy() for name in ("node", "key", "n"))
        order = np.lexsort((node, size, key))
        # A row given twice gives its lines twice.
        order = order[np.append(True, (np.diff(key[order]) != 0) | (np.diff(node[order]) != 0))]
        node, key, size = node[order], key[order], size[order].astype(np.int64)
        signs = np.stack([whole.column(name).to_numpy()[order] for name in LONGS], axis=1).view(np.uint64)
        u, v, crowded = _close(node, size, key, signs, least)
        yield rows(whole.to_batches()[0].take(pa.array(order[crowded])))
        pairs = np.stack((np.minimum(node[u], node[v]), np.maximum(node[u], node[v])), axis=1)
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, side])) for side in (0, 1)]
            + [pa.nulls(len(pairs), kind) for kind in [pa.int64(), pa.int32(), *[pa.int64()] * len(LONGS)]], NAMES)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.nulls(len(batch), pa.int64()), *[batch.column(name) for name in NAMES[2:]]], NAMES)

    NAMES = ["u", "v", "key", "n", *LONGS]
    # Members of the most common keys only pass, spread by themselves.
    return members.repartition(parts, F.when(F.col("many"), F.col("node")).otherwise(F.col("key"))).mapInArrow(
        run, "u long, v long, key long, n int, " + ", ".join(f"{name} long" for name in LONGS))


def _candidate_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The normalised text of each wanted class, read from the document that holds it first."""
    per_doc = staged(wanted.groupBy("_doc", "_digest").agg(
        F.collect_list(F.struct("_line", "_hash")).alias("_list")), "wanted")
    # Repeated rows of a document would give the same lines again.
    held = _with_list(keyed, per_doc, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(parts, batches)):
            rows = []
            for data, wanted_here in zip(batch.column("_text").to_pylist(), batch.column("_list").to_pylist()):
                lines = data.split(b"\n")
                rows += [(w["_hash"], normalised(lines[w["_line"]]).decode("utf-8", "replace"))
                         for w in wanted_here]
            columns = list(zip(*rows)) if rows else [[]] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())],
                ["_hash", "_normal"])

    return held.select("_text", "_list").mapInArrow(
        run, "_hash long, _normal string").dropDuplicates(["_hash"])


def _alike(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``u``, ``v`` whose lines are similar enough."""
    sides = [texts.select(F.col("_hash").alias(side), F.col("_normal").alias(name))
             for side, name in (("u", "_left"), ("v", "_right"))]
    beside = pairs.join(sides[0], "u").join(sides[1], "v").select("u", "v", "_left", "_right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = pa.array([similar(a.split(" "), b.split(" "), least) for a, b in zip(
                batch.column("_left").to_pylist(), batch.column("_right").to_pylist())], pa.bool_())
            yield batch.select(["u", "v"]).filter(alike)

    return beside.mapInArrow(run, "u long, v long")


def cuts(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per document (``_doc``, ``_digest``) the ``_list`` of its lines that go: all of a group but the earliest.

    Earliest is the smallest doc_id (null last), then the digest of the text, then the line number.
    """
    keyed = with_key(docs)
    place = F.struct("_doc", "_digest", "_line")
    seen = staged(explode_texts(keyed, ["_doc", "_digest"], "_hash long, _line int", _lines_of_batch), "seen")
    repeated = staged(seen.groupBy("_hash").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("_hash", "first"), "repeated")
    again = staged(
        seen.join(broadcast_if_small(repeated), "_hash").where(place != F.col("first"))
        .groupBy("_doc", "_digest").agg(F.collect_list("_line").alias("_list")), "again")
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = int(size // SLICE_BYTES) + 1
    met = staged(_met(_packed(keyed, again, least, ranks(keyed), slices), least, slices), "met")
    shared = met.where("key IS NOT NULL")
    signs = met.where("key IS NULL").dropDuplicates(["line"]).select("line", "node", *LONGS)
    signed = shared.select("line", "key", "n", "many").join(signs, "line").drop("line")
    compared = staged(_compared(signed, shared.count() // COMPARED + 1, least), "compared")

    def may(a: Column, b: Column) -> Column:
        most = F.floor(F.greatest(a["n"], b["n"]) * (1 - least) + 1e-9)
        apart = sum((F.bit_count(a[name].bitwiseXOR(b[name])) for name in LONGS), F.lit(0))
        longer = F.abs(a["n"] - b["n"])
        return (longer <= most) & (apart <= 2 * most - longer)

    def alike(pairs: DataFrame) -> DataFrame:
        # Only lines that may be linked are read again.
        involved = staged(pairs.select(F.col("u").alias("_hash")).union(
            pairs.select(F.col("v").alias("_hash"))).distinct(), "involved")
        wanted = seen.join(involved, "_hash").groupBy("_hash").agg(F.min(place).alias("first")).select("first.*", "_hash")
        return _alike(pairs, staged(_candidate_texts(keyed, wanted), "texts"), least)

    members = compared.where("v IS NULL").select(
        F.col("u").alias("node"), "key", F.struct("n", *LONGS).alias("sign"))
    roots = grouped(members, may, alike, paired=compared.where("v IS NOT NULL").select("u", "v")).select(
        F.col("node").alias("_hash"), "root")
    grouping = staged(roots.union(
        repeated.select("_hash", F.col("_hash").alias("root")).join(roots, "_hash", "left_anti")), "grouping")
    held = staged(seen.join(grouping, "_hash").select("root", "_doc", "_digest", "_line"), "held")
    kept = staged(held.groupBy("root").agg(F.min(place).alias("first")), "kept")
    return held.join(broadcast_if_small(kept), "root").where(place != F.col("first")).groupBy(
        "_doc", "_digest").agg(F.collect_set("_line").alias("_list"))


def dedup(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The columns of the documents with repeated lines taken out, ``n_lines`` and ``n_removed``.

    Lines of at least five words are compared with edits allowed, shorter ones are repeated if
    they are equal but for blanks around them; blank lines always stay, as does the order of lines. Texts that lose nothing are unchanged, null stays null. Repeated rows (same id, same
    text) are one document and keep the same lines. Input columns named ``n_lines`` or ``n_removed``
    are replaced. No input rows, no result rows.
    """
    kept_columns = [name for name in docs.columns if name not in ("n_lines", "n_removed")]
    lists = staged(cuts(docs, least).withColumnRenamed("_list", "_goes"), "cuts")
    if fits_broadcast(lists, LISTS):
        lists = F.broadcast(lists)
    joined = with_key(docs.select(*named(kept_columns))).join(lists, ["_doc", "_digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for data, goes in zip(batch.column("_text").to_pylist(), batch.column("_goes").to_pylist()):
                lines = (data or b"").split(b"\n")
                goes = set(goes or ())
                left = [line for number, line in enumerate(lines) if number not in goes]
                counts.append(len(lines) if data else 0)
                removed.append(len(lines) - len(left))
                texts.append(data if len(left) == len(lines) else b"\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(given_as[name]) if name != "text" else
                 pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.string())
                 for name in kept_columns] + [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                [*kept_columns, "n_lines", "n_removed"])

    # Functions over batches take plain names only.
    given_as = {name: f"_kept{n}" for n, name in enumerate(kept_columns) if name != "text"}
    given = joined.select(
        *[column.alias(alias) for column, alias in zip(named(given_as), given_as.values())],
        F.col("text").cast("binary").alias("_text"), "_goes")
    schema = docs.select(*named(kept_columns)).schema.add("n_lines", "long").add("n_removed", "long")
    return given.mapInArrow(run, schema)
