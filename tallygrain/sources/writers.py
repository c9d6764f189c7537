"""Writers: partitioned columnar tables, delimited text with blanks for NULL, and indexed text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.operators.ordering import global_row_number


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], compression: str = "snappy") -> None:
    """Overwrite the touched partitions of an ORC table.

    The rebalance hint groups rows by partition value and lets AQE split a value that holds a large
    share of the rows over several writers and merge small ones, so files come out evenly sized.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
        .partitionBy(*by).orc(path)
    )


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """Delimited text with a header; NULL becomes an empty field."""
    (
        df.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding)
        .option("nullValue", "").option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    )


def write_csv_indexed(df: DataFrame, path: str, order: str, index: str = "index") -> None:
    """As ``write_csv`` with a leading 0-based row index by the unique numeric column ``order``."""
    numbered = global_row_number(df, order, order, out="_rn")
    write_csv(numbered.select((F.col("_rn") - 1).alias(index), *df.columns), path)
