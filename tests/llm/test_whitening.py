"""Whitening against numpy's symmetric eigensolver, exact deviations, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import whitening as wh
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def whole(vectors):
    return np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100_000


def compare(spark, ids, vectors, got, count=8):
    x = whole(vectors)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by) == list(range(1, count + 1))
    exact = {i: sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, s)) for i, row in zip(ids, x)}
    for k, rows in by.items():
        want = y @ basis[:, k - 1] / np.sqrt(values[k - 1])
        have = np.array([rows[i]["whitened"] for i in ids])
        sign = np.sign(want @ have)
        assert np.abs(have * sign - want).max() < 1e-9
        assert {r["n"] for r in rows.values()} == {n}
        assert all(rows[i]["deviation"] == exact[i] for i in ids)
        assert all(abs(r["explained"] - values[k - 1] / np.trace(v)) < 1e-12 for r in rows.values())
        assert all(r["identity_error"] < 1e-9 for r in rows.values())


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    compare(spark, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], wh.op13_whitening(spark, "/root/testdata/sf0.01").collect())


@pytest.mark.parametrize("spectrum", [np.geomspace(1, 1e-6, 30), np.r_[np.linspace(9, 5, 10), np.full(20, 1.0)], np.r_[1e4, np.linspace(3, 1, 29)]])
def test_eigenvectors(spectrum):
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((30, 30)))[0]
    v = (q * spectrum) @ q.T
    for count in (1, 8, 30):
        values, basis = wh.leading_components(v, count)
        assert np.allclose(values, np.sort(spectrum)[::-1][:count], rtol=0, atol=1e-13 * spectrum.max())
        assert np.abs(basis.T @ basis - np.eye(count)).max() < 1e-12
        assert np.abs(v @ basis - basis * values).max() < 1e-12 * spectrum.max()


def test_polar_factor_is_the_sign():
    a = np.random.default_rng(1).standard_normal((25, 25))
    a = a + a.T
    values, basis = np.linalg.eigh(a)
    assert np.abs(wh.polar(a) - (basis * np.sign(values)) @ basis.T).max() < 1e-11


def test_edge_cases(spark):
    rng = np.random.default_rng(2)
    good = [rng.standard_normal(3).tolist() for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(good)] + [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 1.0]), (104, [float("-inf"), 0.0, 1.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit("x").alias(c) for c in ("row", "component", "n", "whitened", "deviation", "v", "i", "at")])
    got = wh.whiten(frame).select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    compare(spark, list(range(40)), good, got, 3)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    for empty in (same, same.limit(1), same.limit(0), same.select("vec_id", F.lit(None).cast("array<double>").alias("embedding")), frame.where("vec_id = 101")):
        assert wh.whiten(empty).count() == 0
    twice = wh.whiten(frame.unionByName(frame.where("vec_id < 3"))).select("row.vec_id", "n", "component")
    assert twice.where("vec_id = 1 and component = 1").count() == 2 and twice.first()["n"] == 43
    flat = spark.createDataFrame([(i, [float(i % 4), float(i % 4) * 2]) for i in range(12)], "vec_id long, embedding array<float>")
    assert {r["component"] for r in wh.whiten(flat).collect()} == {1}  # the other direction has no variance


def test_deviations_beyond_a_long():
    x = np.array([[0, 1 << 40], [5, 7]], np.int64)
    sums = [int(v) for v in x.sum(axis=0)]
    n = 10**9
    sums = [s * (n // 2) for s in sums]
    assert wh.deviations(x, sums, n) == [None, None]
    assert wh.deviations(np.array([[1, 2]], np.int64), [3, 4], 2) == [1]
