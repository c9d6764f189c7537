"""Names for DataFrames and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to SQL under ``name``, replacing an earlier view."""
    df.createOrReplaceTempView(name)
    return df


def replace_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Drop the external table if it exists, then create it over freshly written files."""
    spark: SparkSession = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(name)
    return spark.table(name)
