"""Model fits by their defining equations, evaluation by direct counting."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tallygrain.operators import modeling as m


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    p = 1 / (1 + np.exp(-(0.3 + 1.2 * x[:, 0] - 0.8 * x[:, 1])))
    y = (rng.random(600) < p).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(600)]
    return m.assemble(spark.createDataFrame(rows, "id int, a double, b double, noise double, y int"), ["a", "b", "noise"]).cache()


def test_score_equations_vanish(data):
    fit = m.logit(data, "y", ["a", "b", "noise"])
    scored = fit.predict(data)
    sums = scored.agg(*[F.sum((F.col("y") - F.col("score")) * c) for c in [F.lit(1), F.col("a"), F.col("b"), F.col("noise")]]).first()
    assert list(sums) == pytest.approx([0, 0, 0, 0], abs=1e-4)
    table = {r.term: r for r in fit.coefficients(data).collect()}
    assert table["a"].p < 0.001 and table["noise"].p > 0.01 and table["a"].residual_deviance < table["a"].null_deviance


def test_selection_drops_noise(data):
    fit, path = m.step_aic(data, "y", ["a", "b", "noise"])
    assert set(fit.terms) >= {"a", "b"} and path[-1][1] <= path[0][1]
    backward, removed = m.backward_p(data, "y", ["a", "b", "noise"], alpha=0.01)
    assert backward.terms == ["a", "b"] and [t for t, _ in removed] == ["noise"]


def test_inflation_of_nearly_equal_terms(spark, data):
    close = m.assemble(data.drop(m.ALL).withColumn("twin", F.col("a") + F.col("noise") * 0.1), ["a", "b", "twin"])
    inflation = {r.term: r.vif for r in m.vif(close, m.logit(close, "y", ["a", "b", "twin"])).collect()}
    assert inflation["a"] > 20 and inflation["twin"] > 20 and inflation["b"] < 2


def scores(spark, n=500):
    rng = random.Random(7)
    rows = [(i, 1 if rng.random() < 0.3 else 0, round(rng.random(), 2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, y int, s double").repartition(4)


def test_sweep_equals_repeated_counting(spark):
    rows, df = scores(spark)
    points = m.cutoffs()
    got = {r.cutoff: r for r in m.cutoff_sweep(df, "y", "s", points).collect()}
    assert sorted(got) == points
    positives = sum(y for _, y, _ in rows)
    for c in points[::9]:
        tp = sum(y for _, y, s in rows if s >= c)
        fp = sum(1 - y for _, y, s in rows if s >= c)
        assert got[c].sensitivity == pytest.approx(tp / positives)
        assert got[c].specificity == pytest.approx(1 - fp / (len(rows) - positives))
        one = m.confusion(df, "y", "s", c).first()
        assert (one.tp, one.fp) == (tp, fp) and one.accuracy == pytest.approx(got[c].accuracy)


def test_area_and_gap(spark):
    rows, df = scores(spark)
    area = m.roc_auc(m.roc_curve(df, "y", "s")).first().auc
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    assert area == pytest.approx(sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)))
    flipped = df.withColumn("s", 1 - F.col("s"))
    assert m.roc_auc(m.roc_curve(flipped, "y", "s")).first().auc == pytest.approx(1 - area)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y")
    assert evaluator.evaluate(df.withColumn("y", F.col("y").cast("double"))) == pytest.approx(area, abs=2e-3)
    gap = max(sum(s >= c for s in pos) / len(pos) - sum(s >= c for s in neg) / len(neg) for c in {s for *_, s in rows})
    assert m.ks(df, "y", "s", 0.5).first().ks == pytest.approx(gap)


def test_last_tile_has_full_gain(spark):
    rows, df = scores(spark, 503)
    lift = m.decile_lift(df, "y", "s", "id").orderBy("bucket").collect()
    assert [r.total for r in lift] == [51] * 3 + [50] * 7
    assert lift[-1].gain == pytest.approx(100) and lift[-1].cumlift == pytest.approx(1)
    ordered = [y for _, y, _ in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert lift[0].totalresp == sum(ordered[:51])


def test_hours_and_split(spark):
    df = spark.createDataFrame([(1, 8.004), (1, 7.0), (2, 9.5)], "e int, h double")
    got = {r.e: (r.days, r.total_hours, r.mean_hours) for r in m.worked_hours(df, F.col("h"), "e").collect()}
    assert got == {1: (2, 15.0, 7.5), 2: (1, 9.5, 9.5)}
    assert {r.e: r.mean_hours for r in m.worked_hours(df, F.col("h"), "e", plus_one=True).collect()} == {1: 5.0, 2: 4.75}
    split = m.hash_split(spark.range(5000), "id", 70)
    assert 0.67 < split.where("is_train").count() / 5000 < 0.73


def test_fit_equals_the_library(data):
    """Estimates, errors and deviances against Spark's own GLM."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    for terms in (["a", "b", "noise"], ["b"]):
        vectors = VectorAssembler(inputCols=terms, outputCol="features").transform(data)
        other = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="y", maxIter=50, tol=1e-12).fit(vectors)
        fit = m.logit(data, "y", terms)
        assert list(fit.beta) == pytest.approx([*other.coefficients, other.intercept], abs=1e-7)
        assert list(fit.std_errors) == pytest.approx(other.summary.coefficientStandardErrors, rel=1e-6)
        assert [fit.aic, fit.deviance, fit.null_deviance] == pytest.approx([other.summary.aic, other.summary.deviance, other.summary.nullDeviance], rel=1e-9)
        assert [fit.p_values[t] for t in terms] == pytest.approx(other.summary.pValues[:-1], abs=1e-8)


def test_many_fits_take_one_pass_an_iteration(spark, data, monkeypatch):
    passes = []
    made = m._information
    monkeypatch.setattr(m, "_information", lambda models: passes.append(len(models)) or made(models))
    fits = m.fit_many(data, "y", [["a"], ["a", "b"], ["noise"], ["a", "b", "noise"]])
    assert passes[0] == 4 and len(passes) < 12
    assert [f.aic for f in fits] == pytest.approx([m.logit(data, "y", f.terms).aic for f in fits], rel=1e-12)
    holes = data.withColumn("a", F.when(F.col("id") % 10 > 0, F.col("a")))
    assert {f.rows for f in m.fit_many(holes, "y", [["a"], ["b"]])} == {540}
    assert m.logit(data, "y", ["y"]).deviance < 1e-6  # told apart completely
