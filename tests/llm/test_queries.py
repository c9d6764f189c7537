"""Queries against the SQL they must agree with, and the native ones without Python."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from check_oracle import TABLES, rows_of

from tallygrain.llm import queries
from tallygrain.llm.common import ready

@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    frame = queries.QUERIES[name](spark, FOLDER)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["op2_url_filter", "op8_line_dedup", "op9_mixing"])
def test_native_queries_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
