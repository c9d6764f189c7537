"""Rule-based data quality: named rules, scorecards, cleaning, duplicates, keys and outliers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.quantiles import exact_quantiles
from tallygrain.session import materialize


@dataclass(frozen=True)
class Rule:
    """A named predicate that is true for rows in error and NULL where it cannot be decided."""

    name: str
    violated: Column


def outside_period(column: str, years: Iterable[int], months: Iterable[int] | None = None) -> Column:
    """True where the date lies outside the given years or, if given, the given months."""
    outside = ~F.year(column).isin(list(years))
    if months is not None:
        outside = outside | ~F.month(column).isin(list(months))
    return outside


def any_error(rules: Sequence[Rule], on_null: str = "unknown") -> Column:
    """OR over all rules. ``on_null`` says what an undecidable row is: 'unknown', 'clean' or 'error'."""
    combined = reduce(or_, [rule.violated for rule in rules])
    if on_null == "unknown":
        return combined
    return F.coalesce(combined, F.lit(on_null == "error"))


def errors_by(df: DataFrame, rules: Sequence[Rule], by: str, on_null: str = "unknown") -> DataFrame:
    """Rows in error per provider."""
    return df.where(any_error(rules, on_null)).groupBy(by).agg(F.count("*").alias("errors"))


def scorecard(df: DataFrame, rules: Sequence[Rule], by: str) -> DataFrame:
    """Violations per rule and provider in one pass: (by, rule, violations, rows, percent)."""
    names = [rule.name for rule in rules] + ["any"]
    checks = [rule.violated for rule in rules] + [any_error(rules)]
    wide = df.groupBy(by).agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in zip(names, checks)])
    return wide.unpivot([by, "rows"], names, "rule", "violations").select(
        by, "rule", "violations", "rows", F.round(100 * F.col("violations") / F.col("rows"), 4).alias("percent")
    )


def error_rate(df: DataFrame, rules: Sequence[Rule], by: str) -> DataFrame:
    """Error percentage per provider, with the worst provider marked."""
    rates = (
        df.groupBy(by)
        .agg(F.count("*").alias("rows"), F.count_if(any_error(rules)).alias("errors"))
        .withColumn("error_percent", F.round(100 * F.col("errors") / F.col("rows"), 4))
    )
    worst = rates.agg(F.max_by(by, F.struct("error_percent", by)).alias("worst")).scalar()
    return rates.withColumn("is_worst", F.col(by) == worst)


def clean(df: DataFrame, rules: Sequence[Rule], on_null: str = "unknown") -> DataFrame:
    """Rows that violate no rule; rows whose predicate is NULL stay out unless ``on_null='clean'``."""
    return df.where(~any_error(rules, on_null))


def reconcile(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """total = clean + error + undecided, in one pass."""
    error = any_error(rules)
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(~error).alias("clean"),
        F.count_if(error).alias("errors"),
        F.count_if(error.isNull()).alias("undecided"),
    )
    return counts.withColumn("difference", F.col("total") - F.col("clean") - F.col("errors") - F.col("undecided"))


# --- NULLs ---------------------------------------------------------------------


def row_null_count(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.isnull(c).cast("int") for c in columns])


def has_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.isnull(c) for c in columns])


def all_null_columns(df: DataFrame) -> DataFrame:
    """(column, non_null) for every column, from one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "non_null")


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are NULL in every row; one row of counts reaches the driver."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def constant_columns(df: DataFrame) -> DataFrame:
    """(column, constant): constant columns hold one value in all rows, NULL counting as a value."""
    flags = df.agg(
        *[
            ((F.min(c).eqNullSafe(F.max(c))) & F.count(c).isin(0, F.count("*"))).alias(c)
            for c in df.columns
        ]
    )
    return flags.unpivot([], df.columns, "column_name", "constant")


def drop_constant_columns(df: DataFrame) -> DataFrame:
    constant = {r["column_name"] for r in constant_columns(df).where("constant").collect()}
    return df.select(*[c for c in df.columns if c not in constant])


# --- duplicates and keys -------------------------------------------------------


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, counted from one map-side combined aggregate."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def dedup_keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate rather than a row number: copies are reduced before the shuffle, so a key with very
    many copies costs one row per task instead of one task for all of its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("kept")).select(*[c if c in keys else F.col("kept")[c].alias(c) for c in df.columns])


def dedup_drop_all(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows whose key occurs once."""
    rest = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(F.count("*").alias("copies"), F.any_value(F.struct(*rest)).alias("kept"))
    return single.where("copies = 1").select(*[c if c in keys else F.col("kept")[c].alias(c) for c in df.columns])


def key_uniqueness(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows, distinct keys (NULL counts as one value) and whether the key is unique."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys")).select(
        F.lit(label).alias("table_name"), "rows", "distinct_keys", (F.col("rows") == F.col("distinct_keys")).alias("is_unique")
    )


# --- values --------------------------------------------------------------------


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value, smallest on ties, as a one-row frame."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1).select(column)


def sentinel_to_mode(df: DataFrame, column: str, sentinel) -> DataFrame:
    """Replace a sentinel by the most frequent real value, read through a scalar subquery."""
    mode = mode_of(df.where(F.col(column) != sentinel), column).scalar()
    return df.withColumn(column, F.when(F.col(column) == sentinel, mode).otherwise(F.col(column)))


def cap(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Winsorize columns at fixed bounds; NULL stays NULL."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(c))))
            for c, (lo, hi) in bounds.items()
        }
    )


def percentile_grid(df: DataFrame, columns: Sequence[str], steps: int = 100) -> DataFrame:
    """Quantiles at 0, 1/steps, ..., 1 per column."""
    grid = exact_quantiles(df, columns, [i / steps for i in range(steps + 1)])
    return grid.select("column_name", F.round(F.col("prob") * steps).cast("int").alias("step"), "value")


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Five-number summary and the number of values beyond 1.5 interquartile ranges."""
    five = (
        exact_quantiles(df, columns, [0.0, 0.25, 0.5, 0.75, 1.0], by)
        .groupBy(*by, "column_name")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in
               [(0.0, "low"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "high")]])
    )
    five = materialize(five, "five-numbers")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(by), list(columns), "column_name", "v")
    limits = five.select(*by, "column_name", (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi"))
    outliers = (
        long.join(limits, [*by, "column_name"])
        .groupBy(*by, "column_name")
        .agg(F.count_if((F.col("v") < F.col("_lo")) | (F.col("v") > F.col("_hi"))).alias("outliers"))
    )
    return five.join(outliers, [*by, "column_name"])
