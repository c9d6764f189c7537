"""Wide to long, flags to labels, dummies and column names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim column names, turn spaces into underscores and drop question marks."""
    return df.toDF(*[re.sub(" ", "_", name.strip()).replace("?", "") for name in df.columns])


def to_long(df: DataFrame, ids: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], key, value)


def flags_to_label(df: DataFrame, ids: Sequence[str], label: str) -> DataFrame:
    """One row per raised flag, with the flag's column name as the label."""
    return to_long(df, ids, label, "_flag").where(F.col("_flag") != 0).drop("_flag")


def levels_of(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Sorted levels of a categorical column; refuses columns that are not categorical."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels")
    return sorted(found)


def dummies(df: DataFrame, columns: Sequence[str], levels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """0/1 columns for every level but the first; NULL gives NULL, as in a model matrix."""
    for column in columns:
        names = list(levels[column]) if levels and column in levels else levels_of(df, column)
        df = df.withColumns(
            {f"{column}_{name}": F.when(F.col(column).isNotNull(), (F.col(column) == name).cast("int")) for name in names[1:]}
        ).drop(column)
    return df


def recode_levels(df: DataFrame, column: str, out: str) -> DataFrame:
    """Two-level factor to 0/1 in sorted level order, the levels read through one aggregate."""
    first = df.agg(F.min(column)).scalar()
    return df.withColumn(out, F.when(F.col(column).isNotNull(), (F.col(column) != first).cast("int")))


def swipe_pairs(time_in: DataFrame, time_out: DataFrame, key: str) -> DataFrame:
    """Wide in and out tables (one column per day) to one row per key and day with both times."""
    long_in = to_long(time_in, [key], "day", "time_in").where(F.col("time_in").isNotNull())
    long_out = to_long(time_out, [key], "day", "time_out").where(F.col("time_out").isNotNull())
    return long_in.join(long_out, [key, "day"])
