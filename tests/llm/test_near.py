"""Near copies against Jaccard similarity of all pairs, around the bound."""

from __future__ import annotations

import random

import brute
from meterflow.llm import simhash


def shingles(text):
    words = text.split()
    return {tuple(words[n:n + 5]) for n in range(len(words) - 4)}


def test_near_copies_against_brute_force(spark):
    rng = random.Random(11)
    docs = []
    for changes in (2, 4, 6, 7, 8, 9, 10) * 4:
        base = [f"w{rng.randrange(5000)}" for _ in range(400)]
        copy = list(base)
        for at in rng.sample(range(400), changes):
            copy[at] = f"other{rng.randrange(10**6)}"
        docs += [" ".join(base), " ".join(copy)]
    sets = [shingles(t) for t in docs]
    near = {n for n in range(0, len(docs), 2)
            if len(sets[n] & sets[n + 1]) / len(sets[n] | sets[n + 1]) >= 0.8}
    assert 8 < len(near) < 28
    rows = simhash.near_groups(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    root = {r._doc: r.root for r in rows}
    assert {n for n in range(0, len(docs), 2) if root[n] == root[n + 1]} == near
    want = brute.components(list(range(len(docs))), lambda a, b: a // 2 == b // 2 and min(a, b) in near)
    assert len(set(root.values())) == len(set(want))
