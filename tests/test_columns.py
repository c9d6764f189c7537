"""Scalar functions and reshaping on literal rows."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallygrain.functions import scalars
from tallygrain.operators import reshape


def test_violation_times(spark):
    texts = ["0043A", "1243A", "1230P", "1620P", "0000P", "1A", None, "", "2561A", "12x0P", "1159P "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("m", scalars.violation_minute("t"))
    assert [r.m for r in df.collect()] == [43, 43, 750, 980, 720, None, None, None, None, None, 1439]
    assert [r.c for r in df.select(F.when(F.col("m").isNotNull(), scalars.clock("m")).alias("c")).collect()][:4] == ["00:43", "00:43", "12:30", "16:20"]


def test_hour_bins(spark):
    df = spark.createDataFrame([(0,), (239,), (240,), (1439,), (None,)], "m int")
    assert [r[0] for r in df.select(scalars.hour_bin("m")).collect()] == ["0_3", "0_3", "4_7", "20_23", "unknown"]


def test_bins_and_bounds(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (20.0,), (-1.0,)], "tip double")
    labels = [r[0] for r in df.select(scalars.bin_label("tip", scalars.TIP_BINS, "left", "Bucket_5")).collect()]
    assert labels == ["Bucket_1", "Bucket_1", "Bucket_2", "Bucket_5", "Bucket_5"]
    closed = spark.createDataFrame([(3,), (4,)], "h int").select(scalars.bin_label("h", scalars.HOUR_BINS))
    assert [r[0] for r in closed.collect()] == ["0_3", "4_7"]


def test_december_is_winter(spark):
    df = spark.createDataFrame([(datetime.date(2017, 12, 5),), (datetime.date(2017, 11, 5),), (None,)], "d date")
    assert [r[0] for r in df.select(scalars.season("d")).collect()] == ["Winter", "Fall", "unknown"]
    assert [r[0] for r in df.select(scalars.season("d", "lower")).collect()] == ["winter", "autumn", "unknown"]


def test_category_repair(spark):
    df = spark.createDataFrame([("A0lytics",), ("enterprise 2.0",), ("Fi0nce",), (None,)], "c string")
    assert [r[0] for r in df.select(scalars.repair_category("c")).collect()] == ["analytics", "enterprise 2.0", "finance", None]


def test_zero_duration_has_no_speed(spark):
    t = datetime.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(5.0, t, t), (5.0, t, t + datetime.timedelta(minutes=30))], "d double, a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(scalars.speed("d", "a", "b")).collect()] == [None, 10.0]


def test_dates_that_do_not_parse(spark):
    df = spark.createDataFrame([("31-12-2014",), ("2014-12-31",), ("",)], "d string")
    assert [r[0] for r in df.select(scalars.to_date("d", "dd-MM-yyyy")).collect()] == [datetime.date(2014, 12, 31), None, None]


def test_label_lookup_with_missing_labels(spark):
    df = spark.createDataFrame([(["b", "a"], ["2", "1"])], "l array<string>, v array<string>")
    assert tuple(df.select(*scalars.label_lookup("l", "v", ["a", "b", "c"])).first()) == ("1", "2", None)


def test_names_are_normalized(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Issue Date ", "Unregistered Vehicle?")
    assert reshape.normalize_names(df).columns == ["Issue_Date", "Unregistered_Vehicle"]


def test_dummies_drop_first_level_and_keep_null(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "g string")
    assert [tuple(r) for r in reshape.dummies(df, ["g"]).collect()] == [(0, 0), (1, 0), (0, 1), (None, None)]
    with pytest.raises(ValueError):
        reshape.levels_of(spark.range(50).select(F.col("id").cast("string").alias("g")), "g", limit=10)


def test_flags_and_recode(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 0, 1), ("c", 0, 0)], "k string, x int, y int")
    assert rows(reshape.flags_to_label(df, ["k"], "label")) == [("a", "x"), ("b", "y")]
    coded = reshape.recode_levels(spark.createDataFrame([("Yes",), ("No",), (None,)], "a string"), "a", "b")
    assert [r.b for r in coded.collect()] == [1, 0, None]


def test_swipes_pair_only_full_days(spark):
    i = spark.createDataFrame([(1, "i1", None), (2, "i2", "i3")], "id int, d1 string, d2 string")
    o = spark.createDataFrame([(1, "o1", "o9"), (2, "o2", None)], "id int, d1 string, d2 string")
    assert rows(reshape.swipe_pairs(i, o, "id")) == [(1, "d1", "i1", "o1"), (2, "d1", "i2", "o2")]


def test_clock_of_null_is_null(spark):
    df = spark.createDataFrame([(None,), (0,), (725,)], "m int")
    assert [r[0] for r in df.select(scalars.clock("m")).collect()] == [None, "00:00", "12:05"]
