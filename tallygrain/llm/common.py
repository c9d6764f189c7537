"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.session import prepare, ship_by_value

__all__ = ["ready", "table", "require", "fresh", "host_of", "path_of", "per_worker", "ship_by_value", "ASCII_UPPER", "ASCII_LOWER"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

ship_by_value(__name__)


def ready(spark: SparkSession) -> SparkSession:
    """Session settings; batches to Python hold few rows because texts can be long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> None:
    """Name the missing columns before any work starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the frame has {df.columns}")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def per_worker(kind: str, key: str, make: Callable[[], object]) -> object:
    """``make()``, once per Python worker for a ``key``; the last key of each ``kind`` is kept.

    Modules shipped by value begin anew with every task, so what is dear to build lives beside them.
    """
    kept = sys.modules.setdefault("_tallygrain_worker", types.ModuleType("_tallygrain_worker")).__dict__
    if kept.get(kind, ("", None))[0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or no ``://``."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for NULL or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
