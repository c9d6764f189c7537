"""Neighbourhood recommendations on a long (user, item, rating) frame, never densified.

Ratings meet at the key they share, and pairs are summed before they are shuffled. A key with very many
ratings is dealt into a grid of cells by its degree (``grid_sums``), so that no task holds all its pairs; keys
with few ratings, nearly all of them, are one cell and are not copied. Tables that fill their blocks are
multiplied as dense blocks instead (``pair_sums``), which takes a copy of a rating for each block of the other side; ``co_rated``
chooses by the number of pairs that a block would hold. Where only the nearest rows are wanted, full blocks give these and no pairs
(``nearest_rows``), and their weighted sums are taken block by block too (``spread_sums``): what is shuffled grows with the rows and the blocks, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.session import materialize, ship_by_value

ship_by_value(__name__)

SIM_DIGITS = 9
RATING_DIGITS = 6


# --- preparation ---------------------------------------------------------------


def min_activity(ratings: DataFrame, n_user: int, n_item: int) -> DataFrame:
    """Ratings of users and items with enough ratings, both counted before any filter; counts kept."""
    users = ratings.groupBy("user").agg(F.count("*").alias("user_ratings")).where(F.col("user_ratings") >= n_user)
    items = ratings.groupBy("item").agg(F.count("*").alias("item_ratings")).where(F.col("item_ratings") >= n_item)
    items, users = materialize(items, "active-items"), materialize(users, "active-users")
    return ratings.join(items, "item").join(users, "user").select("user", "item", "rating", "user_ratings", "item_ratings")


def zscore(ratings: DataFrame) -> DataFrame:
    """Add (mean, sd, z) per user; a user whose ratings do not vary has z = 0.

    Means and deviations are combined before the shuffle and joined back as a table, so that a user
    with very many ratings is not gathered in one task.
    """
    stats = ratings.groupBy("user").agg(F.avg("rating").alias("mean"), F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("sd"))
    return ratings.join(materialize(stats, "user-scale"), "user").withColumn("z", F.coalesce(F.try_divide(F.col("rating") - F.col("mean"), F.col("sd")), F.lit(0.0)))


def _scored(ratings: DataFrame) -> DataFrame:
    return ratings if "z" in ratings.columns else zscore(ratings)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Reproducible bucket of a key: the first 32 bits of its MD5 modulo ``buckets``."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def split_fold(train_percent: int = 75) -> Callable[[Column], Column]:
    """Fold 0 holds the test users, fold 1 the training users."""
    return lambda user: (hash_bucket(user, 100) < train_percent).cast("int")


def k_fold(k: int = 5) -> Callable[[Column], Column]:
    return lambda user: hash_bucket(user, k).cast("int")


def withhold_one(ratings: DataFrame) -> DataFrame:
    """Mark one rating per user, the one with the largest hash, as withheld."""
    mark = F.md5(F.concat_ws(":", F.col("user").cast("string"), F.col("item").cast("string")))
    chosen = ratings.groupBy("user").agg(F.max_by("item", mark).alias("_item"))
    return ratings.join(materialize(chosen, "withheld"), "user").withColumn("withheld", F.col("item") == F.col("_item")).drop("_item")


# --- similarity ----------------------------------------------------------------


def _dense(frame: pd.DataFrame, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, at = np.unique(frame["r"].to_numpy(), return_inverse=True)
    values, present = np.zeros((len(rows), len(columns))), np.zeros((len(rows), len(columns)))
    where = np.searchsorted(columns, frame["c"].to_numpy())
    values[at, where] = frame["v"].to_numpy()
    present[at, where] = 1.0
    return rows, values, present


def _multiply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums over common columns for every pair of rows that has one."""
    columns = np.intersect1d(left["c"].to_numpy(), right["c"].to_numpy())
    left, right = left[left["c"].isin(columns)], right[right["c"].isin(columns)]
    a, x, has_x = _dense(left, columns)
    b, y, has_y = _dense(right, columns)
    n = has_x @ has_y.T
    i, j = np.nonzero(n)
    keep = a[i] != b[j]
    i, j = i[keep], j[keep]
    return pd.DataFrame(
        {"a": a[i], "b": b[j], "dot": (x @ y.T)[i, j], "aa": ((x * x) @ has_y.T)[i, j], "bb": (has_x @ (y * y).T)[i, j], "n": n[i, j].astype("int64")}
    )


def pair_sums(left: DataFrame, right: DataFrame, row: str, column: str, value: str, fold: Callable[[Column], Column] | None = None,
              block_rows: int = 1024, block_columns: int = 4096) -> DataFrame:
    """(a, b, dot, aa, bb, n [, fold]) over common columns for pairs of a row of ``left`` and a row of ``right``.

    With ``fold``, a function of the column key, sums are kept apart per fold.
    """
    sizes = left.agg(F.approx_count_distinct(row).alias("l"), F.approx_count_distinct(column).alias("c")).first()
    n_right = sizes["l"] if right is left else right.agg(F.approx_count_distinct(row)).first()[0]
    lb, rb, cb = max(1, -(-sizes["l"] // block_rows)), max(1, -(-n_right // block_rows)), max(1, -(-sizes["c"] // block_columns))
    label = fold(F.col("c")) if fold else F.lit(0)

    def cells(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        base = df.select(F.col(row).cast("bigint").alias("r"), F.col(column).cast("bigint").alias("c"), F.col(value).cast("double").alias("v"))
        return base.select(
            "r", "c", "v", F.pmod(F.xxhash64("r"), F.lit(own_blocks)).cast("int").alias(own), F.pmod(F.xxhash64("c"), F.lit(cb)).cast("int").alias("cb"),
            label.cast("int").alias("fold"), F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other),
        )

    def task(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return _multiply(x, y).assign(fold=np.int32(key[3]))

    keys = ["lb", "rb", "cb", "fold"]
    products = (
        cells(left, "lb", lb, "rb", rb).groupBy(*keys)
        .cogroup(cells(right, "rb", rb, "lb", lb).groupBy(*keys))
        .applyInPandas(task, "a bigint, b bigint, dot double, aa double, bb double, n bigint, fold int")
    )
    by = ["a", "b", "fold"] if fold else ["a", "b"]
    return products.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["dot", "aa", "bb", "n"]])


#: Ratings of one key that a cell of the grid holds on each side, about; its pairs are at most the square.
CELL = 512


def grid(left: DataFrame, right: DataFrame, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """``left`` and ``right`` (``r``, ``c``, ``v``) with the cell (``c``, ``i``, ``j``) in which their rows meet.

    A key ``c`` with n ratings on the left and m on the right has n / cell times m / cell cells. A rating is hashed to
    a line of the grid and copied along it, once for each ``cell`` ratings on the other side: fewer copies than it has
    partners, by the factor ``cell``. Rows whose key the other side lacks go.
    """
    def lines(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("c").agg(F.ceil(F.count("*") / cell).cast("int").alias(name))

    shape = materialize(lines(left, "rows").join(lines(right, "columns"), "c"), "grid")

    def placed(df: DataFrame, own: str, lines_own: str, along: str, lines_other: str, seed: int) -> DataFrame:
        line = F.pmod(F.xxhash64(F.lit(seed), "r"), F.col(lines_own)).cast("int")
        return df.join(shape, "c").select("c", "r", "v", line.alias(own), F.explode(F.sequence(F.lit(0), F.col(lines_other) - 1)).alias(along))

    return placed(left, "i", "rows", "j", "columns", 1), placed(right, "j", "columns", "i", "rows", 2)


def grid_sums(left: DataFrame, right: DataFrame, row: str, column: str, value: str, fold: Callable[[Column], Column] | None = None, cell: int = CELL, ordered: bool = False) -> DataFrame:
    """(a, b, dot, aa, bb, n [, fold]) over common columns for pairs of a row of ``left`` and a row of ``right``.

    With ``fold``, a function of the column key, sums are kept apart per fold; with ``ordered``, only pairs a < b are
    made. NULL keys and values take no part. Pairs are summed where they are made and once more after their shuffle.
    """
    def cells(df: DataFrame) -> DataFrame:
        base = df.select(F.col(row).cast("bigint").alias("r"), F.col(column).cast("bigint").alias("c"), F.col(value).cast("double").alias("v"))
        return base.where("r is not null and c is not null and v is not null")

    x, y = grid(cells(left), cells(right), cell)
    label = [] if fold is None else [fold(F.col("c")).cast("int").alias("fold")]  # once a rating, not once a pair
    x = x.select("c", "i", "j", F.col("r").alias("a"), F.col("v").alias("x"), *label)
    y = y.select("c", "i", "j", F.col("r").alias("b"), F.col("v").alias("y"))
    met = x.join(y, ["c", "i", "j"]).where(F.col("a") < F.col("b") if ordered else F.col("a") != F.col("b"))
    by = ["a", "b", *(["fold"] if fold is not None else [])]
    sums = {"dot": F.sum(F.col("x") * F.col("y")), "aa": F.sum(F.col("x") * F.col("x")), "bb": F.sum(F.col("y") * F.col("y")), "n": F.count("*")}
    return met.groupBy(*by).agg(*[e.alias(c) for c, e in sums.items()])


#: Pairs from which on a block is multiplied as a matrix.
FULL_BLOCK = 10_000


def co_rated(left: DataFrame, right: DataFrame, row: str, column: str, value: str, fold: Callable[[Column], Column] | None = None, ordered: bool = False,
             block_rows: int = 1024, block_columns: int = 4096, full_block: int = FULL_BLOCK) -> DataFrame:
    """The sums of ``grid_sums``, by dense blocks where these hold ``full_block`` pairs on average; the result does not depend on that."""
    if not _fills_blocks(left, right, row, column, block_rows, block_columns, full_block):
        return grid_sums(left, right, row, column, value, fold, ordered=ordered)
    sums = pair_sums(left, right, row, column, value, fold, block_rows, block_columns)
    return sums.where(F.col("a") < F.col("b")) if ordered else sums


def _fills_blocks(left: DataFrame, right: DataFrame, row: str, column: str, block_rows: int = 1024, block_columns: int = 4096, full_block: int = FULL_BLOCK) -> bool:
    """Whether blocks hold ``full_block`` pairs on average."""
    def degrees(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(column).alias("c")).agg(F.count("*").alias(name))

    def blocks(df: DataFrame) -> int:
        return -(-df.agg(F.approx_count_distinct(row)).first()[0] // block_rows)

    met = degrees(left, "l").join(degrees(right, "r"), "c").agg(F.sum(F.col("l").cast("double") * F.col("r")).alias("pairs"), F.count("*").alias("c")).first()
    tiles = blocks(left) * blocks(right) * -(-met["c"] // block_columns)
    return (met["pairs"] or 0.0) >= full_block * tiles


def cosine(sums: DataFrame, min_overlap: int = 2) -> DataFrame:
    """(a, b, sim, n) over co-rated columns, for pairs with enough of them."""
    value = F.try_divide(F.col("dot"), F.sqrt("aa") * F.sqrt("bb"))
    rest = [c for c in sums.columns if c not in ("dot", "aa", "bb")]
    return sums.where(F.col("n") >= min_overlap).select(*rest, F.round(value, SIM_DIGITS).alias("sim")).where(F.col("sim").isNotNull())


def similarity(ratings: DataFrame, axis: str, value: str = "rating", min_overlap: int = 2) -> DataFrame:
    """Cosine between all users or all items that share at least ``min_overlap`` ratings, a < b."""
    row, column = ("user", "item") if axis == "user" else ("item", "user")
    return cosine(co_rated(ratings, ratings, row, column, value, ordered=True), min_overlap)


def nearest(sims: DataFrame, k: int, by: Sequence[str] = ("a",)) -> DataFrame:
    """The k most similar rows per row, smaller key on ties; pruned before the shuffle."""
    window = Window.partitionBy(*by).orderBy(F.desc("sim"), "b")
    return sims.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")


# --- nearest rows without their pairs ------------------------------------------

#: Rows of a block on the left, and entries of a block on the right, about. A task has a block of each.
LEFT_ROWS, RIGHT_ENTRIES = 4096, 4_000_000
#: Rows of both sides that a task compares at once, and columns of a matrix.
TILE_ROWS, TILE_COLUMNS = (1024, 2048), 1024
#: Products of two entries that cost as much as this many cells of a matrix product.
ENTRY_COST = 128


def packed(df: DataFrame, keys: Sequence[str], column: str, value: str) -> DataFrame:
    """(keys, ``c``, ``v``): a row per key with its columns and values as arrays; NULL columns and values take no part."""
    base = df.select(*keys, F.col(column).cast("bigint").alias("c"), F.col(value).cast("double").alias("v")).where("c is not null and v is not null")
    return base.groupBy(*keys).agg(F.collect_list(F.struct("c", "v")).alias("p")).select(*keys, F.col("p.c").alias("c"), F.col("p.v").alias("v"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _copied(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


class _Rows:
    """Packed rows in the order of their keys: ``key``, and the entries ``at`` (row), ``c``, ``v`` in that order."""

    def __init__(self, table: pa.Table, key: str):
        keys, lists = table[key].to_numpy(), table["c"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        self.order = np.argsort(keys, kind="stable")
        self.key = keys[self.order]
        place = np.empty(len(keys), np.int64)
        place[self.order] = np.arange(len(keys))
        at = np.repeat(place, sizes)
        by = np.argsort(at, kind="stable")
        self.at, self.c, self.v = at[by], lists.flatten().to_numpy()[by], table["v"].combine_chunks().flatten().to_numpy()[by]
        self.starts = np.searchsorted(self.at, np.arange(len(keys) + 1))

    def tile(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = slice(self.starts[lo], self.starts[min(hi, len(self.key))])
        return self.at[x] - lo, self.c[x], self.v[x]


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the given ranges all its places: (number of the range, place)."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def _tile_sums(x: tuple, y: tuple, shape: tuple[int, int]) -> list[np.ndarray]:
    """Matrices dot, aa, bb, n of two tiles of entries (row, column, value), by products of matrices or of single entries, whichever is less work."""
    columns = np.intersect1d(x[1], y[1])
    x, y = ([e[np.isin(t[1], columns)] for e in t] for t in (x, y))
    sums = [np.zeros(shape) for _ in range(4)]
    (xi, xc, xv), (yi, yc, yv) = ((t[0], np.searchsorted(columns, t[1]), t[2]) for t in (x, y))
    each = np.bincount(yc, minlength=len(columns))
    if ENTRY_COST * int(each[xc].sum()) < shape[0] * shape[1] * len(columns):
        by = np.argsort(yc, kind="stable")
        yi, yv, first = yi[by], yv[by], np.cumsum(each) - each
        cut = np.searchsorted(np.cumsum(each[xc]), np.arange(1 << 21, int(each[xc].sum()) + (1 << 21), 1 << 21), side="right")
        for lo, hi in zip([0, *cut], [*cut, len(xc)]):
            of, place = _expanded(first[xc[lo:hi]], each[xc[lo:hi]])
            cell, u, w = xi[lo:hi][of] * shape[1] + yi[place], xv[lo:hi][of], yv[place]
            for total, part in zip(sums, (u * w, u * u, w * w, None)):
                total += np.bincount(cell, part, shape[0] * shape[1]).reshape(shape)
        return sums
    for lo in range(0, len(columns), TILE_COLUMNS):
        width = min(TILE_COLUMNS, len(columns) - lo)

        def matrices(i: np.ndarray, c: np.ndarray, v: np.ndarray, rows: int) -> list[np.ndarray]:
            here = (c >= lo) & (c < lo + width)
            cell, v = i[here] * width + c[here] - lo, v[here]
            return [np.bincount(cell, part, rows * width).reshape(rows, width).astype(float) for part in (v, v * v, None)]

        (a, a2, has_a), (b, b2, has_b) = matrices(xi, xc, xv, shape[0]), matrices(yi, yc, yv, shape[1])
        for total, l, r in zip(sums, (a, a2, has_a, has_a), (b, has_b, b2, has_b)):
            total += l @ r.T
    return sums


def _first_of(sim: np.ndarray, b: np.ndarray, i: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each ``i``, the smaller ``b`` on ties, in that order."""
    order = np.lexsort((b, -sim, i))
    return order[np.arange(len(i)) - np.searchsorted(i[order], i[order]) < k]


def _nearest(left: pa.Table, right: pa.Table, k: int, min_overlap: int, apart: bool) -> pa.Table:
    """The k nearest rows of ``right`` for each row of ``left``, tile by tile: rows of ``right`` come by key, so that a later one must be nearer to get in."""
    x, y, step = _Rows(left, "r"), _Rows(right, "r"), 10.0**SIM_DIGITS
    fold_x, fold_y = left["fold"].to_numpy()[x.order], right["fold"].to_numpy()[y.order]
    found = []
    for lo in range(0, len(x.key), TILE_ROWS[0]):
        own = x.key[lo : lo + TILE_ROWS[0]]
        i, b, sim, last = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.full(len(own), -np.inf)
        for at in range(0, len(y.key), TILE_ROWS[1]):
            other = y.key[at : at + TILE_ROWS[1]]
            dot, aa, bb, n = _tile_sums(x.tile(lo, lo + len(own)), y.tile(at, at + len(other)), (len(own), len(other)))
            np.sqrt(np.multiply(aa, bb, out=aa), out=aa)
            valid = (n >= min_overlap) & (aa > 0)
            _, p, q = np.intersect1d(own, other, return_indices=True)
            valid[p, q] = False
            if apart:
                valid &= fold_x[lo : lo + len(own), None] != fold_y[None, at : at + len(other)]
            value = np.divide(dot, aa, out=np.full(dot.shape, -np.inf), where=valid)
            better = valid & (value > (last + 0.4 / step)[:, None])  # rounded values are whole steps
            if len(other) > k and np.count_nonzero(better) > 4 * k * len(own):
                better &= value > (np.partition(value, -k, axis=1)[:, -k] - 2 / step)[:, None]
            p, q = np.nonzero(better)
            if not len(p):
                continue
            new = value[p, q]
            i, b, sim = np.append(i, p), np.append(b, other[q]), np.append(sim, np.copysign(np.floor(np.abs(new) * step + 0.5) / step, new) + 0.0)
            kept = _first_of(sim, b, i, k)
            i, b, sim = i[kept], b[kept], sim[kept]
            full = np.flatnonzero(np.arange(len(i)) - np.searchsorted(i, i) == k - 1)
            last[i[full]] = sim[full]
        found.append((own[i], b, sim))
    a, b, sim = (np.concatenate(parts) if parts else np.empty(0) for parts in (list(zip(*found)) or [(), (), ()]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sim": pa.array(sim, pa.float64())})


def nearest_rows(left: DataFrame, right: DataFrame, row: str, column: str, value: str, k: int, min_overlap: int = 2, fold: Callable[[Column], Column] | None = None,
                 left_rows: int = LEFT_ROWS, right_entries: int = RIGHT_ENTRIES) -> DataFrame:
    """(a, b, sim): what ``nearest`` keeps of ``cosine`` over all pairs of a row of ``left`` and another row of ``right``; with ``fold``, of another fold.

    Every pair is compared, in blocks, but none leaves its task unless it is among the k nearest of its block. A row is sent once for each block of the other side.
    """
    sizes = [df.agg(F.approx_count_distinct(row), F.count("*")).first() for df in (left, right)]
    lb, rb = max(1, -(-sizes[0][0] // left_rows)), max(1, -(-sizes[1][1] // right_entries))

    def rows(df: DataFrame) -> DataFrame:
        keyed = df.where(F.col(row).isNotNull()).withColumn("r", F.col(row).cast("bigint"))
        return packed(keyed, ["r"], column, value).withColumn("fold", fold(F.col("r")).cast("int") if fold else F.lit(0))

    def task(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        return _nearest(x, y, k, min_overlap, fold is not None)

    blocks = rows(left).withColumn("lb", _block(F.col("r"), lb)).withColumn("rb", _copied(rb))
    others = rows(right).withColumn("rb", _block(F.col("r"), rb)).withColumn("lb", _copied(lb))
    # Few bytes, but much work: cells are dealt to as many tasks, which Spark would merge by size.
    x, y = (df.repartition(2 * lb * rb, "lb", "rb").groupBy("lb", "rb") for df in (blocks, others))
    return nearest(x.cogroup(y).applyInArrow(task, "a bigint, b bigint, sim double"), k)


def neighbours(left: DataFrame, right: DataFrame, row: str, column: str, value: str, k: int, min_overlap: int = 2, fold: Callable[[Column], Column] | None = None) -> DataFrame:
    """(a, b, sim): the k most similar rows of ``right`` for each row of ``left``; by blocks where these are full, from sums by pair where pairs are few."""
    if _fills_blocks(left, right, row, column):
        return nearest_rows(left, right, row, column, value, k, min_overlap, fold)
    sims = cosine(grid_sums(left, right, row, column, value), min_overlap)
    if fold is not None:
        sims = sims.where(fold(F.col("a")) != fold(F.col("b")))
    return nearest(sims, k).select("a", "b", "sim")


# --- models --------------------------------------------------------------------


def _spread(rows: pa.Table, lists: pa.Table) -> pa.Table:
    """Sums by user and item of ``w`` times the values of the list of ``key``, and of the absolute values of both."""
    y = _Rows(lists, "key")
    user, key, w = (rows[c].to_numpy() for c in ("user", "key", "w"))
    place = np.searchsorted(y.key, key)
    there = np.flatnonzero((place < len(y.key)) & (y.key[np.minimum(place, len(y.key) - 1)] == key)) if len(y.key) else np.empty(0, np.int64)
    there = there[np.argsort(user[there], kind="stable")]
    users, at = np.unique(user[there], return_inverse=True)
    items, c = np.unique(y.c, return_inverse=True)
    first = y.starts[place[there]]
    sizes = y.starts[place[there] + 1] - first
    ends = np.searchsorted(at, np.arange(len(users)), side="right")  # whole users, about so many products at once
    cuts = np.unique(np.append(ends[np.searchsorted(np.cumsum(sizes)[ends - 1], np.arange(1 << 21, int(sizes.sum()), 1 << 21))], len(there))) if len(there) else []
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0), np.empty(0))]
    for lo, hi in zip([0, *cuts], cuts):
        of, entry = _expanded(first[lo:hi], sizes[lo:hi])
        u, v = w[there[lo:hi]][of], y.v[entry]
        cell, inverse = np.unique(at[lo:hi][of] * len(items) + c[entry], return_inverse=True)
        out.append((users[cell // len(items)], items[cell % len(items)], *(np.bincount(inverse, part, len(cell)) for part in (u * v, np.abs(u), np.abs(v)))))
    return pa.table(dict(zip(["user", "item", "total", "w", "v"], [np.concatenate(parts) for parts in zip(*out)])))


def spread_sums(rows: DataFrame, lists: DataFrame, left_rows: int = 2 * LEFT_ROWS, right_entries: int = RIGHT_ENTRIES) -> DataFrame:
    """(user, item, total, w, v): ``rows`` (user, fold, key, w) joined with ``lists`` (fold, key, item, v), sums of w * v, abs(w) and abs(v).

    Both are dealt into blocks, so that sums are taken before their shuffle, where that copies fewer rows than the join has.
    """
    shape, entries = rows.agg(F.approx_count_distinct("user"), F.count("*")).first(), lists.agg(F.count("*"), F.approx_count_distinct(F.struct("fold", "key"))).first()
    lb, rb = max(1, -(-shape[0] // left_rows)), max(1, -(-entries[0] // right_entries))
    by = ["user", "item"]
    if lb * entries[0] > shape[1] * max(1, entries[0] // max(1, entries[1])):
        joined = rows.join(lists, ["fold", "key"])
        return joined.groupBy(*by).agg(F.sum(F.col("w") * F.col("v")).alias("total"), F.sum(F.abs("w")).alias("w"), F.sum(F.abs("v")).alias("v"))
    left = rows.where("user is not null and key is not null and w is not null").select(
        F.col("user").cast("bigint").alias("user"), "fold", F.col("key").cast("bigint").alias("key"), F.col("w").cast("double").alias("w"))
    left = left.withColumn("lb", _block(F.col("user"), lb)).withColumn("rb", _block(F.col("key"), rb))
    right = packed(lists.withColumn("key", F.col("key").cast("bigint")), ["fold", "key"], "item", "v")
    right = right.withColumn("rb", _block(F.col("key"), rb)).withColumn("lb", _copied(lb))
    cells = ["fold", "lb", "rb"]
    sums = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(_spread, "user bigint, item bigint, total double, w double, v double")
    return sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("total", "w", "v")])


def _predict(sums: DataFrame, weight: str, given: DataFrame) -> DataFrame:
    """Weighted mean of z per (user, item), from sums of ``spread_sums``, back on the user's own scale, for items not given."""
    raw = sums.select("user", "item", F.try_divide("total", weight).alias("_z")).where(F.col("_z").isNotNull())
    unseen = raw.join(given.select("user", "item"), ["user", "item"], "left_anti")
    scale = given.groupBy("user").agg(F.any_value("mean").alias("mean"), F.any_value("sd").alias("sd"))
    return unseen.join(scale, "user").select("user", "item", F.round(F.col("mean") + F.col("_z") * F.col("sd"), RATING_DIGITS).alias("predicted"))


def ubcf(given: DataFrame, train: DataFrame, nn: int = 50, min_overlap: int = 2, fold: Callable[[Column], Column] | None = None) -> DataFrame:
    """User-based prediction of unseen items: (user, item, predicted).

    With ``fold``, users are only compared with users of other folds. Frames that carry ``z`` already
    are used as they are.
    """
    given, train = _scored(given), _scored(train)
    near = materialize(neighbours(given, train, "user", "item", "z", nn, min_overlap, fold), "neighbours")
    rows = near.select(F.col("a").alias("user"), F.lit(0).alias("fold"), F.col("b").alias("key"), F.col("sim").alias("w"))
    sums = spread_sums(rows, train.select(F.lit(0).alias("fold"), F.col("user").cast("bigint").alias("key"), "item", F.col("z").alias("v")))
    return _predict(sums.withColumn("item", F.col("item").cast(train.schema["item"].dataType)), "w", given)


def ibcf(given: DataFrame, train: DataFrame, k: int = 30, min_overlap: int = 2, fold: Callable[[Column], Column] | None = None) -> DataFrame:
    """Item-based prediction of unseen items: (user, item, predicted).

    With ``fold``, the model of a user's fold leaves that fold out: sums over users are additive, so
    it is the sum over all folds minus the user's own, and all folds need one pass.
    """
    given, train = _scored(given), _scored(train)
    half = materialize(co_rated(train, train, "item", "user", "z", fold, ordered=True), "item-pairs")
    parts = ["dot", "aa", "bb", "n"]
    turned = half.select(*[F.col({"a": "b", "b": "a", "aa": "bb", "bb": "aa"}.get(c, c)).alias(c) for c in half.columns])
    sums = half.unionByName(turned)
    if fold is None:
        near = nearest(cosine(sums, min_overlap), k).withColumn("fold", F.lit(0))
        rated = given.withColumn("fold", F.lit(0))
    else:
        folds = sums.select("fold").distinct()
        whole = sums.groupBy("a", "b").agg(
            *[F.sum(c).alias(c) for c in parts], F.collect_list(F.struct("fold", *[F.col(c).alias(f"_{c}") for c in parts])).alias("own"))
        known = folds.agg(F.sort_array(F.collect_set("fold"))).scalar()
        each = whole.withColumn("fold", F.explode(known)).withColumn("own", F.expr("get(filter(own, o -> o.fold = fold), 0)"))
        rest = each.select("a", "b", "fold", *[(F.col(c) - F.coalesce(F.col(f"own._{c}"), F.lit(0))).alias(c) for c in parts])
        near = nearest(cosine(rest, min_overlap), k, ["fold", "a"])
        rated = given.withColumn("fold", fold(F.col("user")))
    near = materialize(near.select("fold", F.col("b").alias("key"), F.col("a").alias("item"), F.col("sim").alias("v")), "neighbours")
    sums = spread_sums(rated.select("user", "fold", F.col("item").cast("bigint").alias("key"), F.col("z").alias("w")), near)
    return _predict(sums.withColumn("user", F.col("user").cast(given.schema["user"].dataType)), "v", given)


def top_n(predicted: DataFrame, n: int) -> DataFrame:
    """The n best unseen items per user with their rank."""
    window = Window.partitionBy("user").orderBy(F.desc("predicted"), "item")
    return predicted.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


# --- evaluation ----------------------------------------------------------------


def eval_topn(recs: DataFrame, withheld: DataFrame, seen: DataFrame, items: DataFrame, ns: Sequence[int], good: float = 4.0) -> DataFrame:
    """Totals over test users of TP, FP, FN, TN per list length, with precision, recall and rates.

    ``recs`` (user, item, rank), ``withheld`` (user, item, rating), ``seen`` (user, given count).
    """
    total_items = items.agg(F.countDistinct("item")).scalar()
    # one short list per user, no longer than the longest n
    lists = recs.groupBy("user").agg(F.collect_list(F.struct("item", "rank")).alias("recs"))
    per_user = (
        withheld.join(seen, "user").join(lists, "user", "left")
        .select(
            "user", "given", (F.col("rating") >= good).cast("int").alias("wanted"), F.greatest(F.size("recs"), F.lit(0)).alias("listed"),
            F.expr("get(filter(recs, r -> r.item = item), 0).rank").alias("rank"),
        )
        .withColumn("n", F.explode(F.array(*[F.lit(int(n)) for n in ns])))
    )
    tp = F.when(F.col("rank") <= F.col("n"), F.col("wanted")).otherwise(0)
    fp = F.least("listed", "n") - tp
    fn = F.col("wanted") - tp
    tn = total_items - F.col("given") - tp - fp - fn
    sums = per_user.groupBy("n").agg(*[F.sum(e).alias(name) for name, e in [("tp", tp), ("fp", fp), ("fn", fn), ("tn", tn)]])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.round(F.try_divide(top, bottom), 6)

    c = F.col
    return sums.select(
        "n", "tp", "fp", "fn", "tn", ratio(c("tp"), c("tp") + c("fp")).alias("precision"), ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
        ratio(c("tp"), c("tp") + c("fn")).alias("tpr"), ratio(c("fp"), c("fp") + c("tn")).alias("fpr"),
    )


def evaluate(ratings: DataFrame, fold: Callable[[Column], Column], test_folds: Sequence[int], ns: Sequence[int], nn: int = 50, k: int = 30,
             good: float = 4.0) -> DataFrame:
    """Evaluate both models, all but one rating given: (algorithm, n, counts and rates).

    One test fold is the split scheme; all folds as test folds is cross-validation, in one pass.
    """
    ratings = materialize(ratings, "ratings")
    marked = materialize(withhold_one(ratings), "ratings-withheld")
    test = marked.where(fold(F.col("user")).isin(list(test_folds)))
    given, withheld = test.where(~F.col("withheld")).select("user", "item", "rating"), test.where("withheld").select("user", "item", "rating")
    single = len(test_folds) == 1
    train = ratings.where(fold(F.col("user")) != test_folds[0]) if single else ratings
    apart = None if single else fold
    given, train = materialize(zscore(given), "given"), materialize(zscore(train), "train")
    seen = given.groupBy("user").agg(F.count("*").alias("given"))
    results = []
    for name, predicted in [("ubcf", ubcf(given, train, nn, fold=apart)), ("ibcf", ibcf(given, train, k, fold=apart))]:
        scores = eval_topn(top_n(predicted, max(ns)), withheld, seen, ratings, ns, good)
        results.append(scores.select(F.lit(name).alias("algorithm"), *scores.columns))
    return results[0].unionByName(results[1])
