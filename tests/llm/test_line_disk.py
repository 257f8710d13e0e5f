"""What line dedup leaves on the disk while it runs."""

from __future__ import annotations

import os
import random

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm import buckets, lines
from meterflow.llm.shared import staged


def test_a_staged_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver's garbage was collected, and added up over the steps of an operator."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {name for folder in disk.localDirsString() for _, _, names in os.walk(folder) for name in names
                if name.startswith("shuffle_") and name.endswith(".data")}

    before = files()
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    kept = staged(rows, "kept")
    assert not files() - before
    assert kept.count() == 7 and rows.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_lines_that_only_share_a_run_give_no_pairs(spark, monkeypatch):
    """Each pair of lines of a crowded key that had about the same length was written, and so were their joins."""
    rng = random.Random(3)
    runs = [f"alpha{n} beta{n} gamma{n}" for n in range(6)]
    texts = []
    for n in range(60):
        words = [f"{rng.getrandbits(40):x}" for _ in range(20)]
        texts.append(" ".join(words[:2] + [x for run in runs for x in (run, words.pop())] + words[2:]))
    near = texts[7].replace("beta3", "other")
    docs = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    written = {}
    for module in (buckets, lines):
        def counted(rows, label, real=module.staged):
            made = real(rows, label)
            written[label] = written.get(label, 0) + made.count()
            return made
        monkeypatch.setattr(module, "staged", counted)
    got = {row.doc_id: row.n_removed for row in lines.dedup(docs).collect()}
    assert got == {n: int(n == 60) for n in range(61)}
    assert written["pairs"] <= 2 and written["across"] <= 2


def test_pairs_by_squares_and_by_few_are_all_pairs(monkeypatch):
    """Members of one task, against every pair by itself."""
    rng = np.random.default_rng(11)
    key = np.sort(rng.choice([3, 4, 9, 11, 12], 400, p=[0.5, 0.3, 0.1, 0.09, 0.01]))
    size = rng.integers(5, 60, 400)
    order = np.lexsort((size, key))
    key, size = key[order], size[order]
    node = rng.permutation(400)
    signs = rng.integers(0, 2**63, (400, 4), np.uint64) & rng.integers(0, 2**63, (1, 4), np.uint64) & np.uint64(0x1111111111111111)
    want = set()
    for b in range(400):
        for a in range(b):
            most = lines.most_edits(int(size[b]), 0.8)
            apart = int(np.bitwise_count(signs[a] ^ signs[b]).sum())
            if key[a] == key[b] and size[b] - size[a] <= most and apart <= 2 * most - (size[b] - size[a]):
                want.add((a, b))
    assert len(want) > 300
    monkeypatch.setattr(lines, "ACROSS", 16)
    monkeypatch.setattr(lines, "DOWN", 32)
    for few in (64, 400, 2):
        monkeypatch.setattr(lines, "FEW", few)
        monkeypatch.setattr(lines, "PAIRED_BUCKET", 1 << 20)
        u, v, crowded = lines._close(node, size, key, signs, 0.8)
        assert {*zip(u.tolist(), v.tolist())} == want and len(u) == len(want) and not len(crowded)
        # Keys with too many pairs are left, whole.
        monkeypatch.setattr(lines, "PAIRED_BUCKET", 4)
        u, v, crowded = lines._close(node, size, key, signs, 0.8)
        full = {k for k in key.tolist() if sum(key[a] == k for a, _ in want) > 2 * (key == k).sum()}
        assert full and {*key[crowded].tolist()} == full and len(crowded) == sum((key == k).sum() for k in full)
        assert {*zip(u.tolist(), v.tolist())} == {(a, b) for a, b in want if key[a] not in full}
