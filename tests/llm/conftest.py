from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

SF_DIR = "/root/testdata/sf0.001"

# Texts that every operator on documents must cope with: null, empty, blank, long, copies, ties.
ODD_TEXTS = [
    (None, "a text without an id " * 3), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "),
    (4, "one"), (5, "same words here again and again " * 12), (5, "same words here again and again " * 12),
    (6, "Ünï\u00a0cödé \u2003ſecret K \x1c\x85 ÀÉ " * 8), (7, "long " * 30_000), (8, None),
    (9, "same words here again and again " * 12), (None, None), (10, "x" * 50_000),
    (11, " ".join(f"w{n}" for n in range(6000))), (12, " ".join(f"w{n}" for n in range(3000, 9000))),
    (None, " ".join(f"w{n}" for n in range(50, 90))), (5, "another text of the same id " * 5),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd documents with null columns and extra columns whose names clash with outputs."""
    return spark.createDataFrame(
        [(i, t, None, None if n % 3 else "src1", None, n, "x", n) for n, (i, t) in enumerate(ODD_TEXTS)],
        "doc_id long, text string, lang string, source string, n_chars long, n_words int, "
        "kept string, fp int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    """(doc_id, text) of the smallest documents table."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return [tuple(row) for row in
            spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=repr)
