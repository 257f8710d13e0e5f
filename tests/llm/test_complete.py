"""Line dedup against all pairs by edit similarity alone, without key or block."""

from __future__ import annotations

import random

import brute
from meterflow.llm import edit, lines


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = f"new{rng.randrange(10**6)}x"
        elif kind == 1 and len(words) > lines.MIN_WORDS:
            del words[at]
        else:
            words.insert(at, rng.choice(words))
    return words


def letters(number):
    return "".join("abcdefghij"[int(c)] for c in str(number))


def line_groups(spark, docs):
    """Lines that stay, by document."""
    got = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {r.doc_id: r.text for r in got}


def expected(docs):
    normals = [lines.normalised(t.encode()).split() for _, t in docs]
    low = brute.components(
        list(range(len(docs))), lambda a, b: edit.similar(normals[a], normals[b], 0.8))
    return {i: t if low[n] == n else "" for n, (i, t) in enumerate(docs)}


def test_lines_of_all_lengths_against_all_pairs(spark):
    rng = random.Random(5)
    docs = []
    for length in (5, 6, 7, 8, 9, 10, 11, 14, 15, 20, 33, 50):
        for _ in range(6):
            base = [letters(rng.randrange(60)) for _ in range(length)]
            docs += [" ".join(base)] + [" ".join(edited(base, rng.randint(1, max(1, length // 5)), rng)) for _ in range(3)]
    docs = list(enumerate(docs))
    want = expected(docs)
    assert line_groups(spark, docs) == want
    assert 100 < sum(not t for t in want.values()) < len(docs)


def test_short_and_unspaced_lines(spark):
    cjk = "今天天气很好我们一起去公园散步吧"
    docs = [(1, "Read more\n-----\n\n12"), (2, "Read more \n-----\n\n13"), (3, cjk), (4, cjk.replace("散", "跑"))]
    assert line_groups(spark, docs) == {1: "Read more\n-----\n\n12", 2: "\n13", 3: cjk, 4: ""}
