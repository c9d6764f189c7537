"""Exact quantiles that neither shuffle a whole column nor bring one group's values into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.operators.cuts import BUCKETS, assign, cut_points, ranges_for
from tallygrain.session import materialize


#: Groups of more rows are divided into ranges; smaller ones are one.
GROUP_ROWS = 100_000
#: Ranges of a divided group, and the size of its sketch (KLL), whose error is a little over one in a hundred.
GROUP_RANGES, SKETCH = 64, 200


def _by_group(values: DataFrame, keys: Sequence[str], group_rows: int) -> DataFrame:
    """``values`` (keys, ``value``) with ``range``, the number of the group's own cut points at or below the value.

    Each large group has a sketch of its own, merged from those of the tasks, so that a group with a narrow band of
    values is divided as evenly as one that covers the column. Sketches are as many as the rows allow large groups.
    """
    large = materialize(values.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > group_rows).select(*keys), "large-groups")
    steps = F.array(*[F.lit(i / GROUP_RANGES) for i in range(1, GROUP_RANGES)])
    sketches = values.join(large, list(keys), "left_semi").groupBy(*keys).agg(F.kll_sketch_agg_double("value", SKETCH).alias("sketch"))
    cuts = materialize(sketches.select(*keys, F.array_distinct(F.kll_sketch_get_quantile_double("sketch", steps)).alias("cuts")), "group-cuts")
    placed = values.join(cuts, list(keys), "left")
    below = F.size(F.filter("cuts", lambda c: c <= F.col("value")))
    return placed.select(*keys, "value", F.when(F.col("cuts").isNull(), 0).otherwise(below).alias("range"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), buckets: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Interpolated quantiles (type 7) in long form: (by..., column_name, prob, value).

    Cut points split each column, or each group with more than ``group_rows`` rows, into ranges of similar size. Counts per
    range, combined before the shuffle, tell the rank at which every range begins and so which ranges
    hold a wanted rank. Only rows of those ranges are shuffled, merged to (value, count), and ordered;
    a range holds about 1/buckets of all rows besides one possibly heavy value, which the merge
    reduces to a single row. Many quantiles ask for more ranges, so that the ranges they touch stay a
    small part of the data. NULL values and NULL groups are left out.
    """
    by, keys = list(by), [*by, "column_name"]
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    if by:
        values = df.select(*by, F.inline(F.array(*cells)))
        for name in [*by, "value"]:
            values = values.where(F.col(name).isNotNull())
        long = _by_group(values, keys, group_rows)
    else:
        placed = assign(df, cut_points(df, columns, buckets or ranges_for(df, max(BUCKETS, 8 * len(probs)))))
        ranged = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"), F.col(f"{c}_range").alias("range")) for c in columns]
        long = placed.select(F.inline(F.array(*ranged))).where(F.col("value").isNotNull())
    sizes = long.groupBy(*keys, "range").agg(F.count("*").alias("rows"))
    upto = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.withColumns(
        {"before": F.sum("rows").over(upto) - F.col("rows"), "total": F.sum("rows").over(Window.partitionBy(*keys))}
    )
    # ranks (from 0) that an interpolated quantile touches, gathered per range
    position = (F.col("total") - 1) * F.col("prob")
    wanted = (
        starts.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("part", position - F.floor(position))
        .withColumn("rank", F.explode(F.array(F.floor(position), F.ceil(position))))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows")))
        .groupBy(*keys, "range", "before")
        .agg(F.collect_set(F.struct("prob", "part", "rank")).alias("ranks"))
    )
    # read twice below; as a table its size is known and decides how it is joined
    wanted = materialize(wanted, "ranks")
    within = Window.partitionBy(*keys, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    merged = long.join(wanted.select(*keys, "range"), [*keys, "range"], "left_semi").groupBy(*keys, "range", "value").agg(F.count("*").alias("n"))
    picked = (
        merged.join(wanted, [*keys, "range"])
        .withColumn("stop", F.col("before") + F.sum("n").over(within))
        .withColumn("hit", F.explode(F.expr("filter(ranks, r -> r.rank >= stop - n and r.rank < stop)")))
    )
    return (
        picked.groupBy(*keys, F.col("hit.prob").alias("prob"))
        .agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.max("hit.part").alias("part"))
        .select(*keys, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))
    )
