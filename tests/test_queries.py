"""Every registered query against its DuckDB equivalent, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from check_oracle import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, connection, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(got, connection.execute(ORACLES[name]).df()) is None


def test_training_summary(spark):
    row = QUERIES["iforest_train_summary"](spark, SF_DIR).first()
    assert row["trees"] == 200 and row["flagged_share"] == 0.1
