"""Cut points that divide a numeric column into ranges of similar size."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 128
#: A range is meant to hold so many rows; the driver holds that many cut points at most, which bounds the broadcast of range tables.
ROWS_PER_RANGE = 2_000_000
MOST_RANGES = 20_000
#: Sampled rows for each range, about; with so many a range is seldom more than half as large again as it should be.
SAMPLE_PER_RANGE = 32
#: A range with more than this many times its share of the rows is divided once more.
TOO_LARGE = 3


def ranges_for(df: DataFrame, least: int = BUCKETS) -> int:
    """Number of ranges for ``df``, in proportion to its rows between ``least`` and ``MOST_RANGES``."""
    return max(least, min(MOST_RANGES, -(-df.count() // ROWS_PER_RANGE)))


def _splits(values: np.ndarray, parts: int) -> list[float]:
    """Values at even places of a sorted sample; one that fills several places is a split itself."""
    if not len(values):
        return []
    return np.unique(values[[i * len(values) // parts for i in range(1, parts)]]).tolist()


def cut_points(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, sample_per_range: int = SAMPLE_PER_RANGE) -> dict[str, list[float]]:
    """Splitters per column from a bounded sample of the rows; a few more than ``buckets`` numbers per column at most.

    The driver sees ``sample_per_range`` rows for each range, whatever the table's size, and then counts and ends
    of the ranges; those that came out too large, for example because most values lie where the sample
    had few, are divided by a sample of their own rows. A value with a large share of the rows shows up as a cut point
    itself. The cut points only steer how work is divided; operators built on them are exact for any choice.
    """
    columns = list(columns)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    rows = df.count()
    table = _sampled(doubles, rows, sample_per_range * buckets).toPandas()
    cuts = {c: _splits(np.sort(table[c].dropna().to_numpy(np.float64)), buckets) for c in columns}
    if rows <= sample_per_range * buckets:
        return cuts  # the sample was the table
    counted = assign(doubles, cuts)
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"{c}_range").alias("range"), F.col(c).alias("value")) for c in columns])
    long = counted.select(F.inline(cells)).where("value is not null and not isnan(value)")
    sizes = long.groupBy("name", "range").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    for name in columns:
        large = {r["range"]: r["n"] for r in sizes if r["name"] == name and r["lo"] < r["hi"] and r["n"] > TOO_LARGE * rows / buckets}
        if large:
            inside = long.where((F.col("name") == name) & F.col("range").isin(list(large))).select("range", "value")
            again = _sampled(inside, sum(large.values()), sample_per_range * buckets).toPandas()
            for of_range, n in large.items():
                values = np.sort(again.loc[again["range"] == of_range, "value"].to_numpy(np.float64))
                cuts[name] = sorted({*cuts[name], *_splits(values, max(2, -(-n * buckets // rows)))})
    return cuts


def _sampled(df: DataFrame, rows: int, wanted: int) -> DataFrame:
    return df if rows <= wanted else df.sample(wanted / rows, seed=29)


def assign(df: DataFrame, cuts: dict[str, list[float]], suffix: str = "_range") -> DataFrame:
    """Add ``<column><suffix>``, the number of cut points at or below the value (binary search in the JVM)."""
    columns = list(cuts)
    doubles = df.withColumns({f"{c}{suffix}": F.col(c).cast("double") for c in columns})
    splits = [[float("-inf"), *cuts[c], float("inf")] for c in columns]
    outputs = [f"{c}{suffix}_" for c in columns]
    placed = Bucketizer(
        splitsArray=[s if len(s) > 2 else [float("-inf"), 0.0, float("inf")] for s in splits],
        inputCols=[f"{c}{suffix}" for c in columns], outputCols=outputs, handleInvalid="keep",
    ).transform(doubles)
    return placed.withColumns({f"{c}{suffix}": F.col(f"{c}{suffix}_").cast("int") for c in columns}).drop(*outputs)
