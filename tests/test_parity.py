"""Every query of the mart against its DuckDB oracle SQL, plus plan checks.

The training-data queries have their tests in tests/llm. Runs at sf0.001 by default (set APPMART_PARITY_SF for another folder). Each
query's physical plan must be free of Python UDFs and of Cartesian or
nested-loop joins.
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(REPO, "scripts"))

import __spark_entry__ as entry  # noqa: E402
import oracle_sql  # noqa: E402
from appmart import catalog  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF = os.environ.get("APPMART_PARITY_SF", "/root/testdata/sf0.001")
FORBIDDEN_IN_PLAN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "PythonUDF")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle_sql():
    assert set(catalog.registry()) == set(oracle_sql.queries())
    assert set(catalog.registry()) <= set(entry.queries()) and set(oracle_sql.queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(catalog.registry()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in FORBIDDEN_IN_PLAN:
        assert word not in plan, f"{key}: {word} in plan"
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[key])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "avg_session_duration_by_country", "avg_session_by_country",
                          "avg_dau_by_country", "avg_wau_by_country", "avg_mau_by_country",
                          "etl_timestamp"]
    assert df.count() >= 0
