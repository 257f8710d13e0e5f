"""Edit similarity of two sequences, of characters or of words."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile
from operator import eq


def _shared(left: Sequence, right: Sequence) -> int:
    """Length of the common beginning."""
    return sum(1 for _ in takewhile(bool, map(eq, left, right)))


def distance(left: Sequence, right: Sequence, most: int) -> int:
    """Levenshtein distance, or any number above ``most`` if it is larger.

    Common ends are cut off first; the rest is done with bit vectors, one step per item
    of the shorter side whatever the length of the longer one.
    """
    if left == right:
        return 0
    if abs(len(left) - len(right)) > most:
        return most + 1
    ahead = _shared(left, right)
    left, right = left[ahead:], right[ahead:]
    behind = _shared(left[::-1], right[::-1])
    left, right = left[: len(left) - behind], right[: len(right) - behind]
    if len(left) < len(right):
        left, right = right, left
    if not right:
        return len(left)
    where: dict = {}
    for place, item in enumerate(left):
        where[item] = where.get(item, 0) | 1 << place
    every, top = (1 << len(left)) - 1, 1 << (len(left) - 1)
    plus, minus, score = every, 0, len(left)
    for done, item in enumerate(right, 1):
        match = where.get(item, 0)
        across = (((match & plus) + plus) ^ plus) | match
        up, down = minus | (every & ~(across | plus)), plus & across
        score += bool(up & top) - bool(down & top)
        if score - (len(right) - done) > most:
            return most + 1
        up, down, beside = (up << 1 | 1) & every, down << 1 & every, match | minus
        plus, minus = down | (every & ~(beside | up)), up & beside
    return score


def similar(left: Sequence, right: Sequence, least: float) -> bool:
    """Whether ``1 - distance / longer length`` is at least ``least``; two empty ones are alike."""
    longer = max(len(left), len(right))
    most = int(longer * (1 - least) + 1e-9)
    return distance(left, right, most) <= most
