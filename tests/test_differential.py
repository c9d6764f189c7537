"""Every query with SQL must give the rows DuckDB gives on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tallygrain.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The smallest tables leave whole months without sales; series need the next size.
SERIES_FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SERIES = ("ts_", "win_moving", "win_lag", "fn_sin")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def ducks():
    return {folder: connect(folder) for folder in {FOLDER, SERIES_FOLDER}}


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, ducks, name):
    folder = SERIES_FOLDER if name.startswith(SERIES) else FOLDER
    frame = QUERIES[name](spark, folder)
    cursor = ducks[folder].execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    order = sorted(names)
    got = sorted([tuple(r[c] for c in order) for r in frame.collect()], key=repr)
    expected = sorted([tuple(r[names.index(c)] for c in order) for r in cursor.fetchall()], key=repr)
    assert len(got) == len(expected)
    wrong = [(g, e) for g, e in zip(got, expected) if not all(same(x, y) for x, y in zip(g, e))]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert frame.columns and frame.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 2
