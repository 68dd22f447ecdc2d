"""Every registered query against its SQL, and the shape of its plan."""

import os

import duckdb
import pytest

from phenoloom.plans import catalog
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

# Blocked matrix products are the one place where rows pass through Python.
PYTHON_ALLOWED = {"LA1_pairwise_overlap", "LA2_pairwise_correlation"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.sql(ORACLE[name])
    want_names, want = rows_of(result.columns, result.fetchall())
    assert names == want_names
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    if name not in PYTHON_ALLOWED:
        assert "InPandas" not in plan and "ArrowEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["P19_significant_entries"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "l_shipdate" not in scan.split("Batched")[0] and "l_tax" in scan
    plan = QUERIES["K4_qq_table"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan
