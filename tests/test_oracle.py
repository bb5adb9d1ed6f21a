"""Every registered query against its SQL twin on the smallest data, and its plan."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as entry_module  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

QUERIES, ORACLES = entry_module.registry.QUERIES, entry_module.registry.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# Shapes no registered query may plan: products of rows and per-row Python.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert [shape for shape in FORBIDDEN if shape in plan] == []
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert rows_of(frame.columns, rows) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
