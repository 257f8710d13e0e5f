"""Hashes of words and of word runs straight from UTF-8 bytes, without an object per word.

Words are the maximal runs of bytes other than blank and 0x09 to 0x0D. Texts are taken in groups of
about a megabyte, a longer text in slices cut between words, so memory is bounded by the group and
by the longest word, not by the longest text (of which only the hashes are held, 8 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GROUP_BYTES = 1 << 20
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# The first n bytes of eight, as a little-endian number.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit numbers over all their bits."""
    values = (values ^ (values >> np.uint64(30))) * K2
    values = (values ^ (values >> np.uint64(27))) * K3
    return values ^ (values >> np.uint64(31))


def _slices(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about ``GROUP_BYTES`` that end at a blank or at the end."""
    start = 0
    while start < len(data):
        end = min(start + GROUP_BYTES, len(data))
        while end < len(data) and not BLANK[data[end]]:
            end += 1
        yield start, end
        start = end


def word_hashes(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (in bytes) of every word; ``lower`` takes A-Z as a-z."""
    found = [_hashed(data[start:end].lower() if lower else data[start:end], start)
             for start, end in _slices(data)]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found))


def _hashed(data: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~BLANK[np.frombuffer(data, np.uint8)]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Eight bytes from every place on.
    eights = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=1)
    hashes = (ends - starts).astype(np.uint64) * K3
    at, left, open_ = starts, ends - starts, slice(None)
    while len(at):
        now = (hashes[open_] ^ (eights[at] & FIRST[np.minimum(left, 8)])) * K1
        hashes[open_] = now ^ (now >> np.uint64(29))
        more = np.flatnonzero(left > 8)
        open_ = more if isinstance(open_, slice) else open_[more]
        at, left = at[more] + 8, left[more] - 8
    return mixed(hashes), starts + offset, ends + offset


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words from the hashes of the words; none if there are fewer."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    run = words[:count].copy()
    for step in range(1, length):
        run = run * K1 + words[step: step + count]
    return mixed(run + np.uint64(length))


def grouped_words(
    texts: list[bytes], lower: bool = False,
) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts: first and last (exclusive) text, the joined bytes, hash, start and end of
    every word, and the place of each text's first word, with the number of words behind the last."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_BYTES):
            size += len(texts[end]) + 1
            end += 1
        data = b" ".join(texts[at:end])
        hashes, starts, ends = word_hashes(data, lower)
        begins = np.cumsum([0, *[len(text) + 1 for text in texts[at:end]]])
        yield at, end, data, hashes, starts, ends, np.searchsorted(starts, begins)
        at = end


def shingle_sets(texts: list[bytes], length: int) -> Iterator[np.ndarray]:
    """Per text the distinct hashes, rising, of its runs of ``length`` words, A-Z as a-z.

    A text with fewer words has one run, all of them; without words it has none.
    """
    for first, last, _, words, _, _, begins in grouped_words(texts, lower=True):
        runs = run_hashes(words, length)
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if b - a >= length:
                yield np.unique(runs[a: b - length + 1])
            else:
                yield run_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)
