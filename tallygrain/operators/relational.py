"""Ranking with ties, group totals, null-safe matching, shares and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.session import materialize


def top_k(df: DataFrame, by: Sequence[str], order: str, k: int, ties: str = "rank", tie_break: Sequence[str] = ()) -> DataFrame:
    """The k largest rows per group by ``order``.

    ``ties``: 'rank' keeps all rows tied at rank k, 'dense' counts distinct values, 'none' takes
    exactly k by the tie-breaking columns. Groups use a rank filter, which Spark applies before the
    shuffle; without groups a threshold from a distributed top-k replaces the global window.
    """
    if by:
        window = Window.partitionBy(*by).orderBy(F.desc(order), *tie_break) if ties == "none" else Window.partitionBy(*by).orderBy(F.desc(order))
        number = {"rank": F.rank(), "dense": F.dense_rank(), "none": F.row_number()}[ties]
        return df.withColumn("_rank", number.over(window)).where(F.col("_rank") <= k).drop("_rank")
    if ties == "none":
        return df.orderBy(F.desc(order), *tie_break).limit(k)
    values = df.select(order).where(F.col(order).isNotNull())
    if ties == "dense":
        values = values.distinct()
    threshold = values.orderBy(F.desc(order)).limit(k).agg(F.min(order)).scalar()
    return df.where(F.col(order) >= threshold)


def add_group_totals(df: DataFrame, by: str, totals: dict[str, Column]) -> DataFrame:
    """Attach aggregates of each row's group; rows with a NULL group get NULL.

    The aggregate is combined before its shuffle, so a group with a large share of the rows is never
    gathered in one task, as a window over the group would. It is written as a table before it is
    joined back: if its size allows a broadcast the rows are not shuffled at all, and if not, AQE can
    split a hot group, which it does only for joins of plain shuffles and not above an aggregate.
    """
    groups = df.where(F.col(by).isNotNull()).groupBy(by).agg(*[e.alias(n) for n, e in totals.items()])
    return df.join(materialize(groups, "group-totals"), by, "left")


def anti_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str, null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is missing in ``right``; null-safe, a NULL key matches a NULL key."""
    keys = right.select(F.col(right_key).alias("_key"))
    condition = F.col(left_key).eqNullSafe(F.col("_key")) if null_safe else F.col(left_key) == F.col("_key")
    return left.join(keys, condition, "left_anti").agg(F.count("*").alias("n"))


def left_map(df: DataFrame, mapping: DataFrame, key: str, map_key: str) -> DataFrame:
    """Left join to a map in which a NULL key matches a NULL key; the map's key column is dropped."""
    renamed = mapping.withColumnRenamed(map_key, "_map_key")
    return df.join(renamed, F.col(key).eqNullSafe(F.col("_map_key")), "left").drop("_map_key")


def share(condition: Column) -> Column:
    """Percentage of rows that meet a condition; an undecided row does not meet it."""
    return F.count_if(condition) / F.count("*") * 100


def group_counts(df: DataFrame, *by: str, out: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(out))


def histogram(df: DataFrame, column: str, low: float, width: float) -> DataFrame:
    """Rows per bin of fixed width; bin b covers [low + b*width, low + (b+1)*width)."""
    binned = F.floor((F.col(column) - low) / width).cast("int")
    return df.where(F.col(column).isNotNull()).groupBy(binned.alias("bin")).agg(F.count("*").alias("n"))


def groups_vs_rest(df: DataFrame, key: str, item: str, k: int, n: int, exclude: Sequence = ()) -> DataFrame:
    """Frequency of items in the k largest groups and in all others together, the n first each.

    One pass over the data; everything after it works on (group, item) counts.
    """
    counts = df.where(~F.col(key).isin(list(exclude))).groupBy(key, item).agg(F.count("*").alias("n"))
    largest = top_k(counts.groupBy(key).agg(F.sum("n").alias("_all")), [], "_all", k, "none", [key]).select(F.col(key).alias("_top"))
    labelled = counts.join(largest, F.col(key) == F.col("_top"), "left").select(
        F.coalesce(F.col("_top").cast("string"), F.lit("Other")).alias("label"), item, "n"
    )
    merged = labelled.groupBy("label", item).agg(F.sum("n").alias("n"))
    return top_k(merged, ["label"], "n", n, "none", [item])


def common_items(df: DataFrame, key: str, item: str, groups: int, k: int, exclude: Sequence = (), factor: float = 1.2) -> DataFrame:
    """Items among the first k of the largest groups: in how many, and how far above their overall share."""
    counts = df.where(~F.col(key).isin(list(exclude))).groupBy(key, item).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(key).agg(F.sum("n").alias("size"))
    largest = top_k(sizes, [], "size", groups, "none", [key])
    overall = counts.groupBy(item).agg(F.sum("n").alias("item_n"))
    total = counts.agg(F.sum("n")).scalar()
    leading = top_k(counts.join(largest, key), [key], "n", k, "rank")
    return (
        leading.join(overall, item)
        .withColumn("share", F.col("n") / F.col("size"))
        .withColumn("overall", F.col("item_n") / total)
        .groupBy(item)
        .agg(F.count("*").alias("in_groups"), F.round(100 * F.max("share"), 4).alias("top_share"), F.round(100 * F.max("overall"), 4).alias("overall_share"),
             F.count_if(F.col("share") > factor * F.col("overall")).alias("exceptional_in"))
        .withColumn("is_common", F.col("in_groups") == groups)
    )


def top_value_in_ranked_group(df: DataFrame, outer: str, group: str, member: str, amount: str, ranks: Sequence[int]) -> DataFrame:
    """Per outer key: rank groups by row count, then the member with the largest amount in the wanted ranks."""
    cells = df.where(F.col(group).isNotNull()).groupBy(outer, group, member).agg(F.count("*").alias("n"), F.sum(amount).alias("amount"))
    cells = materialize(cells, "members")
    sizes = cells.groupBy(outer, group).agg(F.sum("n").alias("n"))
    ranked = sizes.withColumn("group_rank", F.row_number().over(Window.partitionBy(outer).orderBy(F.desc("n"), group)))
    wanted = ranked.where(F.col("group_rank").isin(list(ranks))).select(outer, group, "group_rank")
    return top_k(cells.drop("n").join(materialize(wanted, "ranked-groups"), [outer, group]), [outer, "group_rank"], "amount", 1, "rank")


def mean_and_percentiles(df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """Mean and approximate percentiles in one pass."""
    marks = F.percentile_approx(column, list(probs), accuracy)
    row = df.agg(F.avg(column).alias("mean"), marks.alias("p"))
    return row.select("mean", *[F.col("p")[i].alias(f"p{round(100 * p)}") for i, p in enumerate(probs)])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "correlation")
    return long.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "correlation")
