"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tallygrain.operators import relational as rel
from tallygrain.plans import catalog, q_quality
from tallygrain.plans.standins import Tables
from tallygrain.operators import quality

FOLDER = "/root/testdata/sf0.001"
# These run iterative fits while the query is built; their inputs are covered by the other queries.
FITTED = {"ml_logit_fit", "ml_stepwise_aic", "ml_backward_pvalue", "ml_vif", "ml_predict", "txt_lda", "txt_topic_words", "txt_assign_topic"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - FITTED))
def test_no_product_joins_and_no_row_wise_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, FOLDER))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit "]:
        assert bad not in plan, plan


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    plan = plan_of(t.orders.where(F.col("o_totalprice") > 1000).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    narrow = plan_of(catalog.QUERIES["agg_count_by"](spark, FOLDER))
    assert "ReadSchema: struct<l_linestatus:string>" in narrow


def test_scorecard_reads_the_trips_once(spark):
    plan = plan_of(quality.scorecard(Tables(spark, FOLDER).trips, q_quality.trip_rules(), "vendor"))
    assert plan.count("FileScan") == 2  # line items and orders


def test_hot_join_key_is_split(spark):
    """Half of the rows on one key: AQE divides the partition although the next step shuffles again."""
    keep = {k: spark.conf.get(k) for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"]}
    skew = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set(skew, "100KB")
        spark.conf.set(size, "50KB")
        facts = spark.range(0, 400000, 1, 8).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000).alias("g"), F.col("id").alias("x"))
        totals = rel.add_group_totals(facts, "g", {"n": F.count("*"), "s": F.sum("x")})
        check = totals.groupBy("g").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
        assert check.where("rows != n").count() == 0
        totals.write.format("noop").mode("overwrite").save()
        joined = totals.groupBy((F.col("x") % 10).alias("d")).agg(F.sum("n").alias("n"))
        joined.collect()
        assert "isSkew=true" in plan_of(joined) or "skew=true" in plan_of(joined)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        for k in [skew, size, "spark.sql.adaptive.autoBroadcastJoinThreshold"]:
            spark.conf.unset(k)
