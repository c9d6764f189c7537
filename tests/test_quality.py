"""Rules with NULLs, duplicates, sentinels, bounds."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallygrain.operators import profile, quality
from tallygrain.operators.quality import Rule


@pytest.fixture
def payments(spark):
    return spark.createDataFrame(
        [(1, 1, 0.0), (1, 2, 3.0), (2, None, 0.0), (2, 9, 1.0), (2, None, -1.0)], "vendor int, payment int, tip double")


def payment_rules():
    return [Rule("payment", ~F.col("payment").isin(1, 2)), Rule("cash_tip", (F.col("payment") == 2) & (F.col("tip") != 0)), Rule("tip", F.col("tip") < 0)]


def test_undecided_rows_are_neither_clean_nor_error(payments):
    r = quality.reconcile(payments, payment_rules()).first()
    assert (r.total, r.clean, r.errors, r.undecided, r.difference) == (5, 1, 3, 1, 0)
    assert quality.clean(payments, payment_rules()).count() == 1
    assert quality.clean(payments, payment_rules(), on_null="clean").count() == 2
    assert quality.errors_by(payments, payment_rules(), "vendor", on_null="error").agg(F.sum("errors")).first()[0] == 4


def test_scorecard_counts_each_rule(payments):
    card = {(r.vendor, r.rule): r.violations for r in quality.scorecard(payments, payment_rules(), "vendor").collect()}
    assert card[(1, "cash_tip")] == 1 and card[(2, "payment")] == 1 and card[(2, "tip")] == 1 and card[(2, "any")] == 2


def test_worst_provider(payments):
    worst = [r.vendor for r in quality.error_rate(payments, payment_rules(), "vendor").where("is_worst").collect()]
    assert worst == [2]  # two of three rows in error, against one of two


def test_duplicate_ratings(spark):
    df = spark.createDataFrame([("a", 1, 10, 4.0), ("a", 1, 11, 5.0), ("b", 1, 12, 3.0)], "user string, item int, event int, rating double")
    assert rows(quality.dedup_keep_one(df, ["user", "item"], ["event"])) == [("a", 1, 10, 4.0), ("b", 1, 12, 3.0)]
    assert rows(quality.dedup_drop_all(df, ["user", "item"])) == [("b", 1, 12, 3.0)]
    assert quality.duplicate_count(df).first()[0] == 0
    assert quality.duplicate_count(df.select("user", "item")).first()[0] == 1


def test_keep_one_with_a_hot_key(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", i, rng.random()) for i in range(3000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "key string, ord int, v double").repartition(7)
    first = {}
    for key, o, v in data:
        if key not in first or o < first[key][0]:
            first[key] = (o, v)
    assert {r.key: (r.ord, r.v) for r in quality.dedup_keep_one(df, ["key"], ["ord"]).collect()} == first


def test_sentinel_takes_most_frequent_real_value(spark):
    df = spark.createDataFrame([("99",)] * 5 + [("NY",)] * 3 + [("CA",)] * 2 + [(None,)], "state string")
    assert rows(profile.value_counts(quality.sentinel_to_mode(df, "state", "99"), "state")) == [("CA", 2), ("NY", 8), (None, 1)]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (100.0,), (None,)], "x double")
    assert [r.x for r in quality.cap(df, {"x": (2, 50)}).collect()] == [2.0, 5.0, 50.0, None]


def test_columns_without_values_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None, 8, None), (2, None, 8, 3)], "a int, b int, c int, d int")
    assert quality.drop_all_null_columns(df).columns == ["a", "c", "d"]
    assert quality.drop_constant_columns(df).columns == ["a", "d"]
    assert [r.n for r in df.select(quality.row_null_count(df.columns).alias("n")).collect()] == [2, 1]


def test_null_and_blank_profiles(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "name string")
    assert profile.blank_counts(df, ["name"]).first().blanks == 2
    assert profile.null_percent(df).first().percent == pytest.approx(33.3333)


def test_box_stats_counts_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    r = quality.box_stats(df, ["x"]).first()
    assert (r.low, r.q1, r.median, r.q3, r.high, r.outliers) == (1.0, 2.0, 3.0, 4.0, 100.0, 1)
