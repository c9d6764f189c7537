"""Column profiles: shape, summaries, frequencies, missing values and date coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.quantiles import exact_quantiles


def schema_frame(df: DataFrame) -> DataFrame:
    """(position, column_name, type, rows, columns) of a frame; the rows are counted by Spark."""
    fields = F.array(
        *[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"))
          for i, f in enumerate(df.schema.fields)]
    )
    counted = df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    return counted.select(F.inline(fields), "rows", "columns")


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: values, NULLs, minimum, quartiles, mean, maximum."""
    sums = df.agg(
        F.count("*").alias("_rows"),
        *[F.struct(F.count(c).alias("values"), F.min(F.col(c).cast("double")).alias("low"), F.avg(c).cast("double").alias("mean"),
                   F.max(F.col(c).cast("double")).alias("high")).alias(c) for c in columns],
    )
    basic = sums.unpivot(["_rows"], list(columns), "column_name", "s").select(
        "column_name", F.col("s.values").alias("values"), (F.col("_rows") - F.col("s.values")).alias("nulls"),
        F.col("s.low").alias("low"), F.col("s.mean").alias("mean"), F.col("s.high").alias("high"),
    )
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column_name")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    )
    return basic.join(quartiles, "column_name", "left")


def min_max_avg(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with minimum, maximum and mean of several columns."""
    return df.agg(
        *[e for c in columns for e in (
            F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.round(F.avg(c), 6).alias(f"avg_{c}"))]
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency per value, NULL included."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs and rows per column, from one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("rows"), *[F.count_if(F.isnull(c)).alias(c) for c in columns])
    return wide.unpivot(["rows"], columns, "column_name", "nulls").select("column_name", "nulls", "rows")


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return null_counts(df, columns).withColumn("percent", F.round(F.try_divide(100 * F.col("nulls"), F.col("rows")), 4))


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL or empty strings per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "blanks")


def rows_per_month(df: DataFrame, column: str) -> DataFrame:
    """Rows per calendar year and month."""
    return df.groupBy(F.year(column).alias("yr"), F.month(column).alias("mnth")).agg(F.count("*").alias("n"))
