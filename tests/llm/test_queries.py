"""Registered queries against their SQL twins on the smallest data, and the plans of the native ones."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check import TABLES, rows_of  # noqa: E402

from vintara.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    frame = QUERIES[name](spark, sf_dir)
    cursor = con.execute(ORACLES[name])
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_secret_scan", "op5_kd_shards"])
def test_native_plans(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "ExistingRDD") if x in plan]
