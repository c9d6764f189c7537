"""Embedding whitening: the covariance's eigenvectors by spectral divide and conquer with QDWH polar decompositions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table

ship_by_value(__name__)

COMPONENTS = 8
#: A component x of an entry c is floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries from this size on (2 ** 40) have no place in exact sums; their vectors take no part.
TOO_LARGE = float(1 << 40)
#: The driver and each task hold some square matrices of this order at most.
MOST_DIMENSIONS = 8192

_EPS = np.finfo(float).eps


# ---- eigenvectors, on a matrix as large as the vectors are long ---------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps (QDWH), for a symmetric matrix its sign.

    A step is a QR factorization while its weight is large, then a Cholesky-type solve; six steps reach singular values down to
    rounding.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    low, eye = _EPS, np.eye(n)
    for _ in range(30):
        root = np.cbrt(4 * (1 - low**2) / low**4)
        h = np.sqrt(1 + root) + 0.5 * np.sqrt(8 - 4 * root + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + root)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = b / c * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            new = b / c * x + (h - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        done = 1 - low < 1e-15 and np.linalg.norm(new - x) < 1e-8 * np.sqrt(n)
        x = new
        if done:
            break
    return x


def split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below ``shift``; None if the shift does not part them."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-10 * n:
        return None  # an eigenvalue lies on the shift
    basis = projector @ rng.standard_normal((n, rank))
    for _ in range(2):
        basis = projector @ np.linalg.qr(basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    above, below = whole[:, :rank], whole[:, rank:]
    return None if np.linalg.norm(below.T @ a @ above) > 1e-12 * n * np.linalg.norm(a) else (above, below)


def leading_components(v: np.ndarray, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of ``v``, falling, and their unit eigenvectors as columns.

    The matrix is divided at a shift between its eigenvalues, near their mean, and the parts in turn, the upper one first; parts
    below the wanted number of eigenvalues are left alone. A part that is a multiple of the identity to rounding needs no division: any
    orthonormal basis of it will do.
    """
    rng = np.random.default_rng(seed)
    size = np.linalg.norm(v)
    vectors: list[np.ndarray] = []
    parts = [np.eye(len(v))]
    while parts and len(vectors) < count:
        basis = parts.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        n = len(a)
        mean = np.trace(a) / n
        if n == 1 or np.linalg.norm(a - mean * np.eye(n)) <= 4 * n * _EPS * size:
            vectors += list(basis.T)
            continue
        spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
        halves = next((x for k in range(40) if (x := split(a, mean + spread * (0 if not k else rng.uniform(-0.5, 0.5)), rng))), None)
        if halves is None:
            raise ArithmeticError("no shift divides the spectrum")
        parts += [basis @ halves[1], basis @ halves[0]]
    if not vectors:
        return np.empty(0), np.empty((len(v), 0))
    found = np.array(vectors).T
    values = np.einsum("ij,ij->j", found, v @ found)
    order = np.argsort(-values, kind="stable")[:count]
    return values[order], found[:, order] / np.linalg.norm(found[:, order], axis=0)


# ---- sums over the vectors -----------------------------------------------------------------------------------------


def entries(column: pa.Array, dimension: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, x)`` per length of the vectors in ``column`` that take part, or only for ``dimension``; ``x`` are whole numbers."""
    starts = np.asarray(column.offsets)
    lengths = np.diff(starts)
    flat = column.values  # of the whole parent; offsets point into it
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if flat.null_count == 0 else flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    there = np.asarray(column.is_valid())
    for d in [dimension] if dimension is not None else np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(there & (lengths == d))
        if not d or not len(rows):
            continue
        block = values[starts[rows][:, None] + np.arange(d)]
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = block * SCALE
            fine = (np.abs(scaled) < TOO_LARGE).all(axis=1)  # NaN is not below
        yield d, rows[fine], np.floor(scaled[fine]).astype(np.int64) + OFFSET


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length: the number of vectors and the sums of each dimension, exactly."""
    seen: dict[int, int] = defaultdict(int)
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for d, _, x in entries(batch.column(0)):
            seen[d] += len(x)
            sums[d] = [a + b for a, b in zip(sums.get(d, [0] * d), x.sum(axis=0).tolist())]
    for d, total in sums.items():
        columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([seen[d]] * d, pa.int64()), pa.array(map(Decimal, total), pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, ["d", "i", "n", "total"])


def _centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S / n: whole parts are taken off exactly."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole).astype(float) - np.array([s % n / n for s in sums])


def _products(sums: list[int], n: int, projection: np.ndarray | None):
    """Per task: sums of the products of centred vectors, projected if asked, a row of the matrix a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, mean = 0.0, 0.0
        for batch in batches:
            for _, _, x in entries(batch.column(0), len(sums)):
                y = _centred(x, sums, n)
                y = y if projection is None else y @ projection
                out, mean = out + y.T @ y, mean + y.sum(axis=0)
        if np.ndim(out):
            rows = [*out, mean]  # the last row are the sums
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], ["i", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of partial matrices with equal numbers, added up one by one."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
            sums[i] = sums.get(i, 0.0) + row.values.to_numpy()
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["i", "row"])


def covariance(vectors: DataFrame, sums: list[int], n: int, projection: np.ndarray | None = None) -> np.ndarray:
    """Covariance, with divisor ``n``, of the vectors in the only column, or of their projection: partial products of tasks, added by row."""
    partial = vectors.mapInArrow(_products(sums, n, projection), "i int, row array<double>")
    rows = {r["i"]: np.array(r["row"]) for r in partial.repartition("i").mapInArrow(_added, "i int, row array<double>").collect()}  # the matrix
    total = np.array([rows[i] for i in range(len(rows) - 1)])
    mean = rows[len(rows) - 1] / n
    return total / n - np.outer(mean, mean)


# ---- whitening -------------------------------------------------------------------------------------------------------


def deviations(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2, exactly; None beyond a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    size = float(n) * (np.abs(x - whole).max(initial=0) + 1)
    if size**2 * x.shape[1] < 2.0**62:
        return ((n * (x - whole) - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def _whitened(sums: list[int], n: int, projection: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, x in entries(batch.column(1), len(sums)):
                y = _centred(x, sums, n) @ projection
                values = pa.array(list(y), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(deviations(x, sums, n), pa.int64()), values], ["row", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding") -> DataFrame:
    """``row`` (a struct of the other columns), ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    A row per vector and component, at most ``components`` of them. Vectors that are NULL or hold NULL or non-finite entries, or
    entries of 2 ** 30 and more, take no part, nor do empty ones and those of another length than most have (of equally frequent
    lengths, the larger). Components without variance to rounding have no whitened value and are left out, so that equal vectors, a single
    one or an empty table give an empty result. ``deviation`` is NULL where it exceeds a long. Repeated vectors count and stay;
    NULL ids are kept; other columns are carried in ``row`` and may have any name.

    Sums come from all vectors: exact whole numbers first, then products of what is left after the mean is taken off. The driver holds matrices as
    large as vectors are long, divides their spectrum there, and the projection goes to the tasks.
    """
    require(vectors, vector_col)
    only = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    totals = only.mapInArrow(_totals, "d int, i int, n long, total decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    by_length = totals.where("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector_col]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("row"))
    frame = vectors.select(rest.alias("row"), F.col(vector_col).cast("array<double>").alias("v"))
    if by_length is None or not by_length["n"]:
        d, n, sums = 1, 1, [0]
    else:
        d, n = by_length["d"], by_length["n"]
        if d > MOST_DIMENSIONS:
            raise ValueError(f"vectors of {d} entries; {MOST_DIMENSIONS} is the bound")
        sums = [int(r["total"]) for r in totals.where(F.col("d") == d).orderBy("i").collect()]  # a row a dimension
    v = covariance(only, sums, n) if n > 1 else np.zeros((d, d))
    values, basis = leading_components(v, min(components, d))
    trace = float(np.trace(v))
    real = values > 4 * d * _EPS * max(trace, 0.0)
    values, projection = values[real], basis[:, real] / np.sqrt(values[real])
    error = float(np.abs(covariance(only, sums, n, projection) - np.eye(len(values))).max()) if len(values) else 0.0
    schema = frame.select("row", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened")).schema
    rows = frame.mapInArrow(_whitened(sums, n, projection), schema)
    shares = F.array(*[F.lit(float(e / trace)) for e in values]) if len(values) else F.array().cast("array<double>")
    out = rows.select("row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("row", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
