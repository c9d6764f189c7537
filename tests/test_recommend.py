"""Recommendations against direct computation on a small rating table."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.operators import recommend as rec


def table(seed=1, users=25, items=18, density=0.5):
    rng = random.Random(seed)
    return {(u, i): rng.randrange(2, 11) / 2 for u in range(users) for i in range(items) if u == 0 or rng.random() < density}


def frame(spark, ratings):
    return spark.createDataFrame([(u, i, r) for (u, i), r in ratings.items()], "user int, item int, rating double").repartition(4)


def direct_cosine(ratings, a, b, axis):
    left = {(k[1] if axis == "user" else k[0]): r for k, r in ratings.items() if k[0 if axis == "user" else 1] == a}
    right = {(k[1] if axis == "user" else k[0]): r for k, r in ratings.items() if k[0 if axis == "user" else 1] == b}
    both = left.keys() & right.keys()
    if len(both) < 2:
        return None
    return sum(left[k] * right[k] for k in both) / math.sqrt(sum(left[k] ** 2 for k in both) * sum(right[k] ** 2 for k in both))


@pytest.mark.parametrize("axis", ["user", "item"])
@pytest.mark.parametrize("blocks", [(512, 4096), (4, 3)])
def test_similarity_in_any_blocking(spark, axis, blocks):
    ratings = table()
    row, column = ("user", "item") if axis == "user" else ("item", "user")
    f = frame(spark, ratings)
    sums = rec.pair_sums(f, f, row, column, "rating", block_rows=blocks[0], block_columns=blocks[1])
    got = {(r.a, r.b): r.sim for r in rec.cosine(sums.where("a < b")).collect()}
    keys = sorted({k[0 if axis == "user" else 1] for k in ratings})
    expected = {(a, b): direct_cosine(ratings, a, b, axis) for a, b in itertools.combinations(keys, 2)}
    assert got == pytest.approx({k: v for k, v in expected.items() if v is not None}, abs=1e-8)
    assert all(-1 <= v <= 1 for v in got.values())


def zscores(ratings):
    out, scale = {}, {}
    for u in {u for u, _ in ratings}:
        values = [r for (v, _), r in ratings.items() if v == u]
        m, s = np.mean(values), (np.std(values, ddof=1) if len(values) > 1 else 0.0)
        scale[u] = (m, s)
        out.update({k: (r - m) / s if s else 0.0 for k, r in ratings.items() if k[0] == u})
    return out, scale


def test_constant_ratings_have_zero_score(spark):
    z = {(r.user, r.item): r.z for r in rec.zscore(frame(spark, {(1, 1): 3.0, (1, 2): 3.0, (2, 1): 4.0})).collect()}
    assert z == {(1, 1): 0.0, (1, 2): 0.0, (2, 1): 0.0}


def test_user_based_prediction(spark):
    ratings = table(seed=2)
    given = {k: r for k, r in ratings.items() if k[0] < 5}
    train = {k: r for k, r in ratings.items() if k[0] >= 5}
    (zg, scale), (zt, _) = zscores(given), zscores(train)
    got = {(r.user, r.item): r.predicted for r in rec.ubcf(frame(spark, given), frame(spark, train), nn=4).collect()}
    expected = {}
    for u in range(5):
        sims = []
        for v in range(5, 25):
            both = [i for i in range(18) if (u, i) in zg and (v, i) in zt]
            x, y = np.array([zg[(u, i)] for i in both]), np.array([zt[(v, i)] for i in both])
            if len(both) >= 2 and (x @ x) * (y @ y) > 0:
                sims.append((-round(x @ y / math.sqrt((x @ x) * (y @ y)), 9), v))
        near = sorted(sims)[:4]
        for i in range(18):
            raters = [(-s, v) for s, v in near if (v, i) in zt]
            if (u, i) not in given and raters and sum(abs(s) for s, _ in raters) > 0:
                z = sum(s * zt[(v, i)] for s, v in raters) / sum(abs(s) for s, _ in raters)
                expected[(u, i)] = scale[u][0] + scale[u][1] * z
    assert got == pytest.approx(expected, abs=2e-6)


def test_folds_in_one_pass_equal_separate_runs(spark):
    ratings = frame(spark, table(seed=3, users=40))
    fold = rec.k_fold(3)
    for model in [rec.ubcf, rec.ibcf]:
        together = {(r.user, r.item): r.predicted for r in model(ratings, ratings, 5, fold=fold).collect()}
        apart = {}
        for f in range(3):
            inside = ratings.where(fold(F.col("user")) == f)
            outside = ratings.where(fold(F.col("user")) != f)
            apart.update({(r.user, r.item): r.predicted for r in model(inside, outside, 5).collect()})
        assert together == pytest.approx(apart, abs=2e-6)


def test_top_n_counts(spark):
    recs = spark.createDataFrame([(1, 7, 1), (1, 8, 2), (2, 9, 1)], "user int, item int, rank int")
    withheld = spark.createDataFrame([(1, 8, 4.5), (2, 7, 2.0), (3, 7, 5.0)], "user int, item int, rating double")
    seen = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "user int, given bigint")
    items = spark.createDataFrame([(i,) for i in range(10)], "item int")
    out = {r.n: (r.tp, r.fp, r.fn, r.tn) for r in rec.eval_topn(recs, withheld, seen, items, [1, 2]).collect()}
    assert out == {1: (0, 2, 2, 20), 2: (1, 2, 1, 20)}


def test_activity_counts_come_from_unfiltered_data(spark):
    f = frame(spark, {(1, 1): 3.0, (1, 2): 4.0, (2, 1): 5.0})
    assert [(r.user, r.item) for r in rec.min_activity(f, 2, 2).collect()] == [(1, 1)]


@pytest.mark.parametrize("cell", [512, 7, 1])
def test_grid_sums_in_any_cells(spark, cell):
    ratings = table(seed=4)
    f = frame(spark, ratings)
    for axis, row, column in [("user", "user", "item"), ("item", "item", "user")]:
        sums = rec.grid_sums(f, f, row, column, "rating", cell=cell, ordered=True)
        got = {(r.a, r.b): r.sim for r in rec.cosine(sums).collect()}
        keys = sorted({k[0 if axis == "user" else 1] for k in ratings})
        expected = {(a, b): direct_cosine(ratings, a, b, axis) for a, b in itertools.combinations(keys, 2)}
        assert got == pytest.approx({k: v for k, v in expected.items() if v is not None}, abs=1e-8)


@pytest.mark.parametrize("hot", ["user", "item"])
def test_a_hot_key_is_dealt_into_cells(spark, hot):
    """One key with 3,000 ratings beside 500 keys with three each: cells stay small, and cold keys are not copied."""
    many = [(0, i, 1.0 + i % 5) for i in range(3000)] + [(k, 3000 + 3 * k + i, 2.0) for k in range(1, 501) for i in range(3)]
    f = spark.createDataFrame([(c, r, v) for c, r, v in many], "c bigint, r bigint, v double")
    x, y = rec.grid(f, f, cell=100)
    for side in (x, y):
        sizes = [r["count"] for r in side.groupBy("c", "i", "j").count().collect()]
        assert max(sizes) < 170 and side.count() == 3000 * 30 + 1500
    ratings = f.select(F.col("c").alias(hot), F.col("r").alias("item" if hot == "user" else "user"), F.col("v").alias("rating"))
    axis = "user" if hot == "item" else "item"
    pairs = rec.grid_sums(ratings, ratings, axis, hot, "rating", cell=100, ordered=True)
    assert pairs.count() == 3000 * 2999 // 2 + 500 * 3


def test_dense_blocks_and_grid_agree(spark):
    ratings = frame(spark, table(seed=8))
    fold = rec.k_fold(3)
    for args in (("user", "item", "rating"), ("item", "user", "rating", fold)):
        dense, sparse = ({tuple(r)[:2] + (r["fold"] if "fold" in r else 0,): (r.dot, r.aa, r.bb, r.n) for r in rec.co_rated(ratings, ratings, *args, ordered=True, full_block=full).collect()} for full in (1, 10**9))
        assert dense.keys() == sparse.keys() and all(dense[k] == pytest.approx(sparse[k]) for k in dense)


def test_user_pairs_do_not_leave_their_block(spark, monkeypatch):
    """What is ranked are the nearest of a block, not all pairs of users."""
    seen, nearest = [], rec.nearest
    monkeypatch.setattr(rec, "nearest", lambda sims, k, by=("a",): (seen.append(sims.count()), nearest(sims, k, by))[1])
    ratings = frame(spark, table(seed=5, users=200, items=12, density=0.8))
    assert rec.ubcf(ratings, ratings, 5).count() > 0
    assert seen == [200 * 5]


@pytest.mark.parametrize("tiles, entry_cost", [((1024, 2048), 128), ((7, 5), 128), ((16, 9), 0), ((16, 9), 10**9)])
def test_nearest_rows_in_any_blocks(spark, monkeypatch, tiles, entry_cost):
    """Against all pairs and their rank: ties, repeated ratings, folds, rows that others lack, products of matrices and of entries."""
    monkeypatch.setattr(rec, "TILE_ROWS", tiles)
    monkeypatch.setattr(rec, "TILE_COLUMNS", 4)
    monkeypatch.setattr(rec, "ENTRY_COST", entry_cost)
    rng = random.Random(6)
    values = [(u, i, float(rng.choice([-1, 0, 1, 2]))) for u in range(60) for i in range(15) if rng.random() < 0.4]
    left = spark.createDataFrame([x for x in values if x[0] < 40] + values[:9], "user int, item int, v double")
    right = spark.createDataFrame([x for x in values if x[0] >= 20] + values[-9:] + [(70, None, 1.0), (70, 3, None), (None, 3, 1.0)], "user int, item int, v double")
    for fold in (None, rec.k_fold(3)):
        sims = rec.cosine(rec.grid_sums(left, right, "user", "item", "v"), 2)
        sims = sims if fold is None else sims.where(fold(F.col("a")) != fold(F.col("b")))
        expected = sorted((r.a, r.b, r.sim) for r in rec.nearest(sims, 4).collect())
        got = sorted((r.a, r.b, r.sim) for r in rec.nearest_rows(left, right, "user", "item", "v", 4, 2, fold, left_rows=15, right_entries=60).collect())
        assert [x[:2] for x in got] == [x[:2] for x in expected] and [x[2] for x in got] == pytest.approx([x[2] for x in expected], abs=2e-9) and got


def test_spread_sums_by_blocks_and_by_a_join(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(50), rng.randrange(2), rng.randrange(9), rng.random() - 0.5) for _ in range(900)]
    lists = [(f, k, i, rng.random() - 0.5) for f in range(2) for k in range(3, 12) for i in range(20)]
    left, right = spark.createDataFrame(rows, "user bigint, fold int, key bigint, w double"), spark.createDataFrame(lists, "fold int, key bigint, item bigint, v double")
    expected = {}
    for u, f, k, w in rows:
        for g, key, i, v in lists:
            if (f, k) == (g, key):
                t = expected.setdefault((u, i), [0.0] * 3)
                t[0], t[1], t[2] = t[0] + w * v, t[1] + abs(w), t[2] + abs(v)
    for blocks in ({}, {"left_rows": 20, "right_entries": 100}, {"left_rows": 1}):
        got = {(r.user, r.item): (r.total, r.w, r.v) for r in rec.spread_sums(left, right, **blocks).collect()}
        assert got.keys() == expected.keys() and all(got[x] == pytest.approx(expected[x]) for x in got)
