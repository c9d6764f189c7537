"""Ties, NULL keys, group totals and composite rankings."""

from conftest import rows
from pyspark.sql import functions as F

from tallygrain.operators import relational as rel


def counts(spark):
    return spark.createDataFrame([("g", "a", 5), ("g", "b", 4), ("g", "c", 4), ("g", "d", 3)], "g string, code string, n int")


def test_ties_at_rank_k(spark):
    df = counts(spark)
    for by in ([], ["g"]):
        assert rel.top_k(df, by, "n", 2, "rank").count() == 3
        assert rel.top_k(df, by, "n", 2, "dense").count() == 3
        assert rel.top_k(df, by, "n", 3, "dense").count() == 4
        assert [r.code for r in rel.top_k(df, by, "n", 2, "none", ["code"]).orderBy("code").collect()] == ["a", "b"]


def test_rank_filter_runs_before_the_shuffle(spark):
    plan = rel.top_k(counts(spark), ["g"], "n", 2, "dense")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_null_keys(spark):
    a = spark.createDataFrame([(1,), (None,)], "k int")
    b = spark.createDataFrame([(2, "x"), (None, "y")], "k2 int, v string")
    assert rel.anti_count(a, b, "k", "k2").first().n == 1
    assert rel.anti_count(a, b, "k", "k2", null_safe=False).first().n == 2
    assert rows(rel.left_map(a, b, "k", "k2")) == [(1, None), (None, "y")]


def test_group_totals_leave_null_group_without_total(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 2.0), (None, 5.0)], "g string, x double")
    out = rel.add_group_totals(df, "g", {"c": F.count("*"), "t": F.sum("x")})
    assert rows(out) == [("s", 1.0, 2, 3.0), ("s", 2.0, 2, 3.0), (None, 5.0, None, None)]


def test_groups_vs_rest(spark):
    data = [(1, "x")] * 5 + [(1, "y")] * 2 + [(2, "y")] * 4 + [(3, "z")] * 2 + [(4, "z")] * 1 + [(0, "x")] * 50
    df = spark.createDataFrame(data, "p int, c string")
    assert rows(rel.groups_vs_rest(df, "p", "c", 2, 1, exclude=[0])) == [("1", "x", 5), ("2", "y", 4), ("Other", "z", 3)]


def test_common_items(spark):
    data = [(1, "x")] * 6 + [(1, "y")] * 2 + [(2, "x")] * 5 + [(2, "z")] * 1 + [(3, "y")] * 1
    r = {x.c: x for x in rel.common_items(spark.createDataFrame(data, "p int, c string"), "p", "c", 2, 1).collect()}
    assert set(r) == {"x"} and r["x"].is_common and r["x"].in_groups == 2


def test_top_member_in_ranked_groups(spark):
    data = [("u", "s1", "a", 1.0), ("u", "s1", "a", 2.0), ("u", "s1", "b", 2.5), ("u", "s2", "c", 9.0), ("v", "s2", "d", 1.0), ("u", None, "e", 99.0)]
    df = spark.createDataFrame(data, "country string, sector string, company string, amount double")
    out = rel.top_value_in_ranked_group(df, "country", "sector", "company", "amount", [1, 2])
    assert sorted((r.country, r.group_rank, r.company, r.amount) for r in out.collect()) == [("u", 1, "a", 3.0), ("u", 2, "c", 9.0), ("v", 1, "d", 1.0)]


def test_histogram_and_share(spark):
    df = spark.createDataFrame([(0.0,), (0.9,), (1.0,), (None,)], "x double")
    assert rows(rel.histogram(df, "x", 0, 1)) == [(0, 2), (1, 1)]
    assert df.agg(rel.share(F.col("x") > 0.5)).first()[0] == 50.0
