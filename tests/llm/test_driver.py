"""What plans and rounds ask of the driver's memory."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tallygrain.llm import graph, url_filter
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def test_the_words_of_a_filter_are_in_the_plan_once(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    level = url_filter.encode(keys, 500, 77)
    word = str(max(level.words, key=lambda w: len(str(w))))
    found = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key")).where(level.test(F.col("key")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count(word) == 1
    assert 500 <= found.count() < 700 and found.where(F.substring("key", 2, 9).cast("int") < 500).count() == 500
    assert spark.range(1).where(level.test(F.lit(None).cast("string"))).count() in (0, 1)  # a NULL key is not an error


def test_rounds_of_components_are_few_tasks(spark):
    rng = random.Random(3)
    names = list(range(300))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(299) if i % 30 != 29] + [(1000, 1000 + i) for i in range(1, 200)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(2)
    context, group, old = spark.sparkContext, uuid.uuid4().hex, {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    context.setJobGroup(group, "components")
    try:
        got = {r["node"]: r["root"] for r in graph.components(frame).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    chains = [names[i : i + 30] for i in range(0, 300, 30)]
    assert got == {n: min(c) for c in chains for n in c} | {1000 + i: 1000 for i in range(200)}
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    assert tasks < 1000
