"""Compare queries with their DuckDB equivalents: ``python tests/check_oracle.py SF_DIR [names]``."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as spark_entry
from meterflow.session import local_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    def cell(value):
        if pd.isna(value):
            return "null"
        if isinstance(value, (float, np.floating)):
            return repr(float(value) + 0.0)
        if isinstance(value, (bool, np.bool_)):
            return str(bool(value))
        if isinstance(value, (int, np.integer)):
            return repr(float(value))
        return str(value)

    text = frame[sorted(frame.columns)].astype(object).map(cell)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    got, want = canonical(got), canonical(want)
    unequal = (got != want).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows, e.g.\n{got[unequal].head(3).to_string()}\n" \
               f"{want[unequal].head(3).to_string()}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("check_oracle", "8", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - started
            problem = None
            if name in oracles:
                problem = differences(got, connection.execute(oracles[name]).df())
            note = "" if name in oracles else " (no oracle)"
        except Exception as error:
            got, took, problem, note = [], time.time() - started, f"{type(error).__name__}: {str(error)[-2500:]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {len(got)} rows {took:.2f}s{note} {problem or ''}",
              flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
