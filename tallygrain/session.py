"""Session settings and the scratch location for tables that outlive one plan."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on. Skewed join partitions are split by AQE even where
# that costs one more exchange, because a single key may hold a large share of the rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallygrain")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of its own machine;
    on a cluster executors could not see such a folder, so the setting is required there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tallygrain-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def ship_by_value(module: str) -> None:
    """Send functions of a module to workers by value, so that executors need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several later steps read to the shared folder, and read it back.

    The table outlives lost executors, cuts the lineage, keeps column pruning, and gives the
    optimizer true sizes for its choice of join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go as soon as it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote and that no later plan reads."""
    files = df.inputFiles()
    if files:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(conf).delete(folder, True)
