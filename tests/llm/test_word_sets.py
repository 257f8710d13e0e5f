"""Parity bits of shingle sets never turn away a pair that shares enough."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm.word_sets import may_share, parities


def test_no_similar_pair_is_turned_away(spark):
    rng = np.random.default_rng(8)
    rows = []
    for size in (1, 2, 9, 10, 60, 64, 65, 120, 128, 129, 700, 1030):
        for changed in (0.0, 0.02, 0.05, 0.1, 0.3, 0.9):
            for _ in range(6):
                base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
                left = np.unique(base)
                right = np.unique(np.concatenate([
                    base[rng.random(size) >= changed], rng.integers(0, 1 << 63, int(size * changed * rng.random()), dtype=np.uint64)]))
                if len(right) and max(len(left), len(right)) <= 2 * min(len(left), len(right)):
                    both = len(np.intersect1d(left, right))
                    rows.append((parities(left).tolist(), parities(right).tolist(), len(left), len(right),
                                 both / (len(left) + len(right) - both)))
    table = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, n long, m long, share double")
    got = table.select("n", "share", may_share(F.col("a"), F.col("b"), F.col("n"), F.col("m"), 90).alias("may")).collect()
    assert all(r.may for r in got if r.share >= 0.9) and sum(r.share >= 0.9 for r in got) > 60
    far = [r.may for r in got if r.share < 0.7 and r.n >= 100]
    assert len(far) > 30 and sum(far) <= len(far) // 20
