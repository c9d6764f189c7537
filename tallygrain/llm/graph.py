"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.session import materialize


def _directed(edges: DataFrame) -> DataFrame:
    """Every edge once, from its larger to its smaller node; loops and NULL ends go."""
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a != b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it; ``changed`` marks ties that are new."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    moved = edges.select("u", "v").join(least, F.col("v") == F.col("k"))
    return moved.select("u", F.col("m").alias("v"), (F.col("m") != F.col("v")).alias("changed"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them, whose own edge stands for that of the node; each tie once."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    other = F.col("v") != F.col("m")
    moved = edges.join(least, F.col("u") == F.col("k")).select(F.when(other, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (F.col("changed") | other).alias("changed"))
    return moved.groupBy("u", "v").agg(F.bool_or("changed").alias("changed"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge ``(a, b)``; the root is the smallest node of its component.

    Each star writes the edges to the shared folder, so that lost executors cost one star, the lineage stays short and the driver
    follows no task twice; edges tell whether they changed, and a round that changes none is the last. A hub is handled by partial
    aggregates and by joins whose other side has one row a node, which AQE splits. The number of rounds is logarithmic; ``most_rounds``
    only guards against a fault and raises.
    """
    now = materialize(_directed(edges), "edges")
    for _ in range(most_rounds):
        now = materialize(_small_star(materialize(_large_star(now), "large-star")), "edges")
        if now.where("changed").isEmpty():
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError("the contraction did not settle")
