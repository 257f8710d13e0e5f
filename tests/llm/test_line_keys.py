"""Line dedup sends keys packed and by slice, and lists lines of common keys apart."""

from __future__ import annotations

import os
import random

from meterflow.llm import lines
from meterflow.session import shared_dir


def _size(folder):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names)


def test_keys_of_unlike_lines_are_not_written(spark):
    """Every key of every line was written out, over 200 bytes a line."""
    rng = random.Random(5)
    docs = spark.createDataFrame(
        [(n, "\n".join(" ".join(f"{rng.getrandbits(30):x}" for _ in range(40)) for _ in range(20))) for n in range(400)],
        "doc_id long, text string").repartition(2)
    folder = shared_dir(spark).removeprefix("file:")
    before = _size(folder) if os.path.isdir(folder) else 0
    assert all(row.n_removed == 0 for row in lines.dedup(docs).collect())
    assert _size(folder) - before < 150 * 8000


def test_slices_and_common_keys_change_nothing(spark, monkeypatch):
    near = [f"the same words stand here again and again but for number {'abcdefghij'[n % 10] * 3}" for n in range(50)]
    docs = spark.createDataFrame(
        [(n, f"{line}\nalone {n} {'xyz'[n % 3]} {'klmnop'[n % 6] * 9} {'qrstu'[n % 5] * 7} {'vw'[n % 2] * 5} end")
         for n, line in enumerate(near)], "doc_id long, text string")
    want = sorted(tuple(row) for row in lines.dedup(docs).collect())
    assert sum(row[3] for row in want) > 40
    monkeypatch.setattr(lines, "SLICE_BYTES", 500)
    assert sorted(tuple(row) for row in lines.dedup(docs).collect()) == want
    monkeypatch.setattr(lines, "HOT_RANK", 0)
    assert sorted(tuple(row) for row in lines.dedup(docs).collect()) == want
