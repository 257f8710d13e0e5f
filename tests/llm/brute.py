"""Plain, sequential versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring(docs: list[tuple], window: int = 20) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256), rows of equal ids not touching each other."""
    first: dict[tuple, float] = {}
    split = [(float("inf") if i is None else i, words_of(t)) for i, t in docs]
    for number, words in split:
        for at in range(len(words) - window + 1):
            gram = tuple(words[at: at + window])
            first[gram] = min(first.get(gram, number), number)
    rows = []
    for (doc_id, _), (number, words) in zip(docs, split):
        gone, seen = set(), set()
        for at in range(len(words) - window + 1):
            gram = tuple(words[at: at + window])
            if first[gram] < number or gram in seen:
                gone.update(range(at, at + window))
            seen.add(gram)
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        rows.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return rows


def base_secrets(text: str | None) -> tuple:
    """(n_assign, n_access, n_hex, base list) by the literal patterns."""
    text = text or ""
    patterns = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                   re.ASCII | re.I, lambda m: len(m.group(2)) >= 6),
        "access": (r"AKIA[A-Z0-9]+", re.ASCII, lambda m: len(m.group()) >= 20),
        "hex": (r"[0-9a-f]+", re.ASCII, lambda m: len(m.group()) >= 24)}
    spans, counts = [], []
    for order, (kind, (pattern, flags, fits)) in enumerate(patterns.items()):
        found = [m.span() for m in re.finditer(pattern, text, flags) if fits(m)]
        counts.append(len(found))
        spans += [(a, order, b, kind) for a, b in found]
    return (*counts, ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)))


def simhash(text: str | None, shingle: int = 3) -> int:
    words = words_of((text or "").translate(ASCII_LOWER))
    grams = [" ".join(words[n: n + shingle]) for n in range(len(words) - shingle + 1)] \
        or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(numbers: list, linked) -> list:
    """Smallest number reachable, for items whose pairs ``linked(a, b)`` says are linked."""
    root = list(range(len(numbers)))

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a in range(len(numbers)):
        for b in range(a):
            if find(a) != find(b) and linked(a, b):
                root[find(a)] = find(b)
    groups: dict[int, list] = {}
    for n, number in enumerate(numbers):
        groups.setdefault(find(n), []).append(number)
    return [min((x for x in groups[find(n)] if x is not None), default=None)
            for n in range(len(numbers))]


def simhash_components(docs: list[tuple], shingle: int = 3, distance: int = 2) -> list[tuple]:
    """(doc_id, fingerprint, component_id); pairs by matrix, for a few thousand documents."""
    fps = [simhash(t, shingle) for _, t in docs]
    distinct = sorted(set(fps))
    values = np.array(distinct, np.uint64)
    neighbours = {
        fp: set(values[np.bitwise_count(values ^ np.uint64(fp)) <= distance].tolist())
        for fp in distinct}
    lowest: dict[int, int | None] = {}
    done: set[int] = set()
    for fp in distinct:
        if fp in done:
            continue
        group, stack = {fp}, [fp]
        while stack:
            for other in neighbours[stack.pop()] - group:
                group.add(other)
                stack.append(other)
        done |= group
        ids = [i for (i, _), f in zip(docs, fps) if f in group and i is not None]
        for member in group:
            lowest[member] = min(ids, default=None)
    return [(i, f"{fp:016x}", lowest[fp]) for (i, _), fp in zip(docs, fps)]


def quality_base(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = words_of(text)
    lines = text.split("\n")
    dup = sum(1 for n, line in enumerate(lines) if WORD.search(line) and line in lines[:n])
    grams: dict[tuple, list[int]] = {}
    for n in range(len(words) - 4):
        grams.setdefault(tuple(words[n: n + 5]), []).append(n)
    covered = {n + k for places in grams.values() if len(places) > 1 for n in places
               for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup,
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))
