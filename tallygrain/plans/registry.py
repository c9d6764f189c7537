"""Registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrain.plans.standins import Tables, with_views
from tallygrain.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` may use the listed stand-in views."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn

    return register
