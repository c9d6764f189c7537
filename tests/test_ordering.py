"""Distributed order statistics against plain Python, with heavy ties and NULLs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.operators import cuts, ordering, quantiles
from tallygrain.sources import readers, writers


def sample(kind, n=2000, seed=3):
    rng = random.Random(seed)
    if kind == "hot":
        return [5.0 if rng.random() < 0.4 else rng.random() * 10 for _ in range(n)]
    if kind == "constant":
        return [1.0] * n
    if kind == "narrow":
        return [1e9 + rng.random() for _ in range(n)]
    return [float(rng.randrange(40)) - 20 for _ in range(n)]


KINDS = ["hot", "constant", "narrow", "integers"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("descending", [False, True])
def test_row_number_is_exact(spark, kind, descending):
    values = sample(kind)
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double").repartition(5)
    got = {r.id: r.row_number for r in ordering.global_row_number(df, "x", "id", descending, buckets=16).collect()}
    order = sorted(range(len(values)), key=lambda i: (-values[i] if descending else values[i], i))
    assert got == {i: k + 1 for k, i in enumerate(order)}


def test_row_number_puts_null_last(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, None), (4, 1.0)], "id int, x double")
    got = {r.id: r.row_number for r in ordering.global_row_number(df, "x", "id").collect()}
    assert got == {4: 1, 2: 2, 1: 3, 3: 4}


@pytest.mark.parametrize("n,groups", [(23, 10), (100, 10), (7, 10), (10, 3)])
def test_ntile_sizes(spark, n, groups):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(n)], "id int, x double")
    df.createOrReplaceTempView("ntile_input")
    expected = {r.id: r.t for r in spark.sql(f"SELECT id, ntile({groups}) OVER (ORDER BY x DESC, id) AS t FROM ntile_input").collect()}
    got = {r.id: r.tile for r in ordering.ntile(df, groups, "x", "id", descending=True).collect()}
    assert got == expected


def test_running_totals(spark):
    rng = random.Random(5)
    keys = rng.sample(range(10000), 700)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k int, v int").repartition(4)
    got = {r.k: (r.cum_v, r.all_v) for r in ordering.running_totals(df, "k", ["v"], buckets=8).collect()}
    total, expected = 0, {}
    whole = sum(k % 7 for k in keys)
    for k in sorted(keys):
        total += k % 7
        expected[k] = (total, whole)
    assert got == expected


@pytest.mark.parametrize("kind", KINDS)
def test_quantiles_are_exact(spark, kind):
    values = sample(kind)
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)] + [(0, None)], "g int, x double").repartition(5)
    probs = [0, 0.1, 0.25, 0.5, 0.77, 1]
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, ["x"], probs, ["g"], buckets=16).collect()}
    assert len(got) == 3 * len(probs)
    for g in range(3):
        group = [v for i, v in enumerate(values) if i % 3 == g]
        for p in probs:
            assert got[(g, float(p))] == pytest.approx(np.quantile(group, p), rel=1e-12)


def test_quantiles_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    assert {r.value for r in quantiles.exact_quantiles(df, ["x"], [0, 0.5, 1]).collect()} == {2.0}
    assert quantiles.exact_quantiles(df.where("x > 5"), ["x"], [0.5]).count() == 0


def test_assign_counts_cuts_at_or_below(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (3.0,)], "x double")
    assert [r.x_range for r in cuts.assign(df, {"x": [1.0, 2.0]}).orderBy("x").collect()] == [0, 1, 1, 2]


def test_indexed_csv(spark, tmp_path):
    df = spark.createDataFrame([(30, "c"), (10, "a"), (20, None)], "k int, v string")
    writers.write_csv_indexed(df, str(tmp_path / "x"), "k")
    back = readers.read_delimited(spark, str(tmp_path / "x"))
    assert sorted(tuple(r) for r in back.collect()) == [("0", "10", "a"), ("1", "20", None), ("2", "30", "c")]


def test_partitioned_orc_overwrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "orc")
    writers.write_partitioned(spark.createDataFrame([(1, 11, 1.0), (2, 12, 2.0)], "d int, m int, x double"), path, ["m", "d"])
    writers.write_partitioned(spark.createDataFrame([(2, 12, 9.0)], "d int, m int, x double"), path, ["m", "d"])
    back = spark.read.orc(path)
    assert sorted((r.m, r.d, r.x) for r in back.collect()) == [(11, 1, 1.0), (12, 2, 9.0)]
    plan = back.where("m = 12")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_ranges_grow_with_rows_up_to_a_bound(spark, monkeypatch):
    from tallygrain.operators import cuts

    df = spark.range(5000)
    assert cuts.ranges_for(df) == cuts.BUCKETS
    monkeypatch.setattr(cuts, "ROWS_PER_RANGE", 10)
    assert cuts.ranges_for(df) == 500 and cuts.ranges_for(df, 900) == 900
    monkeypatch.setattr(cuts, "MOST_RANGES", 300)
    assert cuts.ranges_for(df) == 300


def test_splitters_divide_a_skewed_column_evenly(spark, monkeypatch):
    """Nearly all values lie in a band that a small sample meets, but does not resolve."""
    rng = random.Random(11)
    values = [rng.random() * 1e-6 if rng.random() < 0.98 else rng.random() * 1e6 for _ in range(40_000)] + [7.0] * 12_000
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    asked = []
    sampled = cuts._sampled
    monkeypatch.setattr(cuts, "_sampled", lambda frame, rows, wanted: asked.append(wanted) or sampled(frame, rows, wanted))
    points = cuts.cut_points(df, ["x"], 32, sample_per_range=4)
    assert max(asked) == 128 and 7.0 in points["x"] and len(points["x"]) < 80
    sizes = {r["x_range"]: r["n"] for r in cuts.assign(df.where("x != 7"), {"x": points["x"]}).groupBy("x_range").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) < 4 * len(values) / 32


def test_large_whole_numbers_keep_their_order(spark):
    """Around 2 ** 60, 256 whole numbers share a double."""
    rng = random.Random(12)
    keys = rng.sample(range(2**60, 2**60 + 6000), 2500) + [2**53 + k for k in range(50)] + [-(2**60) - k for k in range(300)]
    df = spark.createDataFrame([(k, k % 5) for k in keys], "k bigint, v int").repartition(5)
    numbers = {r.k: r.row_number for r in ordering.global_row_number(df, "k", "k", buckets=16).collect()}
    assert numbers == {k: i + 1 for i, k in enumerate(sorted(keys))}
    falling = {r.k: r.row_number for r in ordering.global_row_number(df, "k", "v", True, buckets=16).collect()}
    assert falling == {k: i + 1 for i, k in enumerate(sorted(keys, reverse=True))}
    got = {r.k: r.cum_v for r in ordering.running_totals(df, "k", ["v"], buckets=8).collect()}
    total = 0
    for k in sorted(keys):
        total += k % 5
        assert got[k] == total
    wide = df.select((F.col("k").cast("decimal(38,10)") + F.lit("0.0000000001").cast("decimal(38,10)")).alias("d"), "k")
    assert {r.k: r.row_number for r in ordering.global_row_number(wide, "d", "k", buckets=16).collect()} == numbers


def test_one_group_with_nearly_all_rows(spark):
    """A group in a narrow band beside groups that span the column: its ranges come from its own sketch."""
    rng = random.Random(13)
    rows = [("big", 5 + rng.random() * 1e-3) for _ in range(30_000)] + [("big", 5.0005)] * 5_000 + [(f"g{i}", rng.random() * 1e6) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probs = [0, 0.1, 0.5, 0.9, 1]
    got = {(r.g, r.prob): r.value for r in quantiles.exact_quantiles(df, ["x"], probs, ["g"], group_rows=1000).collect()}
    for g in ["big", "g0", "g39"]:
        values = [x for name, x in rows if name == g]
        assert [got[(g, float(p))] for p in probs] == pytest.approx(np.quantile(values, probs), rel=1e-12)
    placed = quantiles._by_group(df.select("g", F.lit("x").alias("column_name"), F.col("x").alias("value")), ["g", "column_name"], 1000)
    sizes = [r["n"] for r in placed.where("g = 'big' and value != 5.0005").groupBy("range").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 40 and max(sizes) < 3 * 35_000 / quantiles.GROUP_RANGES


def test_periods_are_one_scan_and_pruned(spark, tmp_path):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, 2015), (2, 2016), (3, None)], "k int, period int")
    df.write.partitionBy("period").option("header", True).csv(str(tmp_path / "p"))
    back = readers.read_partitioned(spark, str(tmp_path / "p"), T.StructType.fromDDL("k int"), "period")
    assert sorted((r.k, r.period) for r in back.collect()) == [(1, 2015), (2, 2016), (3, None)]
    plan = back.where("period = 2016")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(period" in plan
