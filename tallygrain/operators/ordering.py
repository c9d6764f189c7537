"""Global order without a global sort task: exact row numbers, tiles and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.operators.cuts import assign, cut_points, ranges_for

_WORK = ["_key", "_slot", "_sub", "_before", "_total"]


def _one_value(df: DataFrame, key: str) -> Column:
    """Whether equal doubles of ``key`` mean equal values: not for large whole numbers and long decimals."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.DecimalType):
        return F.lit(kind.precision <= 15)
    return F.abs("_key") <= 2.0**53 if isinstance(kind, T.LongType) else F.lit(True)


def _order(key: str, descending: bool) -> Column:
    return F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()


def _slotted(df: DataFrame, key: str, tie: str | None, descending: bool, buckets: int) -> DataFrame:
    """Place rows in slots whose order agrees with (key, tie); more rows get more slots, up to the bound of ``ranges_for``.

    Cut points divide the key into ranges. A value that is itself a cut point, possibly a very
    frequent one, gets a slot of its own, and such single-valued slots are divided further by ranges
    of the tie-breaking column. Slots come from the key as a double; inside them rows are ordered by the key itself. NULL keys come last.
    """
    keyed = df.withColumn("_key", -F.col(key).cast("double") if descending else F.col(key).cast("double"))
    if tie is not None:
        keyed = keyed.withColumn("_sub", F.col(tie).cast("double"))
    cuts = cut_points(keyed, ["_key", "_sub"] if tie is not None else ["_key"], buckets)
    placed = assign(keyed, cuts)
    on_cut = F.coalesce(F.col("_key").isin(cuts["_key"]), F.lit(False)) if cuts["_key"] else F.lit(False)
    slot = F.when(F.col("_key").isNull(), 2 * len(cuts["_key"]) + 2).otherwise(2 * F.col("_key_range") + F.when(on_cut, 0).otherwise(1))
    single = (on_cut & _one_value(df, key)) | F.col("_key").isNull()
    sub = F.when(single, F.col("_sub_range")).otherwise(0) if tie is not None else F.lit(0)
    return placed.withColumns({"_slot": slot, "_sub": sub}).drop("_key_range", "_sub_range")


def global_row_number(df: DataFrame, score: str, tie: str, descending: bool = False, out: str = "row_number", buckets: int | None = None) -> DataFrame:
    """Exact 1-based row number by (score, tie) over the whole frame, plus the row count as ``<out>_of``.

    ``score`` and ``tie`` are numeric and ``tie`` is unique. The frame is read twice more than once
    (cut points, slot sizes), so an expensive one should be materialized by the caller.
    """
    placed = _slotted(df, score, tie, descending, buckets or ranges_for(df))
    sizes = placed.groupBy("_slot", "_sub").agg(F.count("*").alias("_rows"))
    # one row per slot: bounded by the number of cut points, whatever the data
    upto = Window.orderBy("_slot", "_sub").rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.select(
        "_slot", "_sub",
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_slot", "_sub").orderBy(_order(score, descending), tie)
    return (
        placed.withColumn(out, F.row_number().over(inside))
        .join(F.broadcast(starts), ["_slot", "_sub"])
        .withColumns({out: F.col("_before") + F.col(out), f"{out}_of": F.col("_total")})
        .drop(*_WORK)
    )


def ntile(df: DataFrame, groups: int, score: str, tie: str, descending: bool = False, out: str = "tile") -> DataFrame:
    """The same tiles as SQL ``ntile`` over one global window; earlier tiles take the extra rows."""
    numbered = global_row_number(df, score, tie, descending, "_rn")
    base = F.floor(F.col("_rn_of") / groups)
    extra = F.col("_rn_of") % groups
    wide = extra * (base + 1)
    tile = F.when(F.col("_rn") <= wide, F.ceil(F.col("_rn") / (base + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("_rn") - wide, base))
    )
    return numbered.withColumn(out, tile.cast("int")).drop("_rn", "_rn_of")


def running_totals(df: DataFrame, key: str, sums: Sequence[str], descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` and ``all_<c>`` for every column in ``sums``; ``key`` is unique per row."""
    placed = _slotted(df, key, None, descending, buckets or ranges_for(df))
    sizes = placed.groupBy("_slot").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    # one row per slot: bounded by the number of cut points, whatever the data
    upto = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    starts = sizes.select(
        "_slot",
        *[(F.sum(f"_sum_{c}").over(upto) - F.col(f"_sum_{c}")).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(Window.partitionBy()).alias(f"all_{c}") for c in sums],
    )
    inside = Window.partitionBy("_slot").orderBy(_order(key, descending)).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in sums})
    joined = local.join(F.broadcast(starts), "_slot")
    return joined.withColumns({f"cum_{c}": F.col(f"_before_{c}") + F.col(f"cum_{c}") for c in sums}).drop(
        *_WORK, *[f"_before_{c}" for c in sums]
    )
