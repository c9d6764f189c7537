"""Approximate nearest neighbours in a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

#: The tree is fitted on the rows with the smallest hashes, so many at most; every row is indexed.
SAMPLE = 20_000
BRANCHES = 8
#: Rows a leaf should hold, and sample rows that it needs at least.
LEAF_ROWS = 400
LEAF_SAMPLE = 16
#: Leaf visits widen until this share of the true neighbours of CALIBRATION queries is in the leaves.
RECALL = 0.98
CALIBRATION = 200
#: Rows of a cell (small leaves together, or a part of a large one), and queries, that a task compares at once, about.
BLOCK = 2048
SEED = 11


class Tree:
    """Inner nodes hold the centres of their children; a child is an inner node (0 or more) or a leaf (``~leaf``)."""

    def __init__(self) -> None:
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0

    def grow(self, rows: np.ndarray, leaf_sample: int, rng: np.random.Generator) -> int:
        parts = _kmeans(rows, BRANCHES, rng) if len(rows) > leaf_sample else None
        if parts is None:
            self.leaves += 1
            return ~(self.leaves - 1)
        centres, label = parts
        node = len(self.children)
        self.centres.append(centres)
        self.children.append([])
        self.children[node] = [self.grow(rows[label == k], leaf_sample, rng) for k in range(len(centres))]
        return node

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row, by the nearest centre at every node."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))] if self.children else []
        while todo:
            node, at = todo.pop()
            nearest = _distances(rows[at], self.centres[node]).argmin(axis=1)
            for k, child in enumerate(self.children[node]):
                own = at[nearest == k]
                if child < 0:
                    out[own] = ~child
                elif len(own):
                    todo.append((child, own))
        return out

    def best_bins(self, row: np.ndarray, visits: int) -> list[int]:
        """Leaves in the order in which a search from the nearest open bin reaches them, the first ``visits`` of them."""
        if not self.children:
            return [0]
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if node < 0:
                found.append(~node)
                continue
            for d, child in zip(_distances(row[None, :], self.centres[node])[0], self.children[node]):
                heapq.heappush(queue, (float(d), child))
        return found


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)[None, :]


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray] | None:
    """Centres and labels of at most ``k`` clusters; nothing if the rows cannot be parted."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        label = _distances(rows, centres).argmin(axis=1)
        used = np.unique(label)
        centres = np.stack([rows[label == c].mean(axis=0) for c in used])
    label = _distances(rows, centres).argmin(axis=1)
    used, label = np.unique(label, return_inverse=True)
    return (centres[used], label) if len(used) > 1 else None


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the same way for every row, so that equal vectors have equal scores."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` of the rows that take part."""
    v = F.col(vector_col)
    huge = F.lit(float("inf"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge)) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & fine)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), "n").limit(1).collect()
    return rows.where(F.size("v") == sizes[0]["n"]) if sizes else rows


def _assign(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v").to_pylist())
            leaf = tree.leaf_of(_unit(rows)) if len(rows) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    return run


_ASKED = "query_id long, qv array<double>, cell long, leaves array<long>"


def _visits(tree: Tree, visits: int, cells: dict[int, tuple[int, int]]):
    """A row per query and cell that holds rows of the leaves it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v").to_pylist())
            take, cell, leaves = [], [], []
            for i, row in enumerate(_unit(rows) if len(rows) else rows):
                wanted: dict[int, list[int]] = {}
                for leaf in tree.best_bins(row, visits):
                    first, n = cells.get(leaf, (0, 0))
                    for c in range(first, first + n):
                        wanted.setdefault(c, []).append(leaf)
                take += [i] * len(wanted)
                cell += wanted
                leaves += wanted.values()
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("v").take(at), pa.array(cell, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], ["query_id", "qv", "cell", "leaves"])

    return run


def _places(tree: Tree):
    """For each query and true neighbour (``leaf``) the place of its leaf in the order of visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("v").to_pylist())
            order = [tree.best_bins(r, tree.leaves) for r in (_unit(rows) if len(rows) else rows)]
            place = [o.index(leaf) for o, leaf in zip(order, batch.column("leaf").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64())], ["place"])

    return run


def _compare(k: int):
    """Within a cell: for each query the rows of its leaves that may be among its ``k`` nearest, with exact scores.

    A row stands for all rows with its vector by their ``k + 1`` smallest ids. One more row than ``k`` is kept, as the query's own may not count.
    """

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            q, b = _matrix(queries["qv"].tolist()), _matrix(rows["v"].tolist())
            leaves, of_row = np.unique(rows["leaf"].to_numpy(), return_inverse=True)
            visited = np.array([np.isin(leaves, x) for x in queries["leaves"]])
            near = np.where(visited[:, of_row], _unit(q) @ _unit(b).T, -np.inf)
            keep = min(k + 1, len(b))
            least = np.partition(near, len(b) - keep, axis=1)[:, len(b) - keep]
            at, row = np.nonzero((near >= least[:, None] - 1e-12) & np.isfinite(near))
            score = _cosine(q[at], b[row])
            ids, own = rows["ids"].to_numpy(), queries["query_id"].to_numpy()
            for i, r, s in zip(at, row, score):
                out += [(own[i], int(x), float(s)) for x in ids[r] if x != own[i]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


_FOUND = "query_id long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _in_cells(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Candidates of ``queries`` (``_ASKED``) among ``rows`` (``v``, ``ids``, ``leaf``, ``cell``), cell by cell against blocks of queries of bounded size."""
    asked = queries.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    parts = materialize(asked, "asked")
    left = queries.join(parts, "cell").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks"))).drop("blocks")
    right = rows.join(parts, "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "leaf", "v", "ids")
    return left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInPandas(_compare(k), _FOUND)


class Index:
    """Tree, indexed rows and the number of leaf visits that calibration found."""

    def __init__(self, vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE, recall: float = RECALL):
        require(vectors, id_col, vector_col)
        self.k = k
        usable = materialize(_usable(vectors, id_col, vector_col), "vectors")
        # Equal vectors are one row with the smallest of their ids, which decide every tie.
        order = Window.partitionBy("v").orderBy("id")
        first = usable.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
        distinct = materialize(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
        # Of about twice the sample, which a bound on the hash lets through, the smallest hashes: no task sorts more than that.
        share = min(1.0, 2 * sample / max(1, distinct.count()))
        few = distinct.where(F.xxhash64("v") <= F.lit(min((1 << 63) - 1, round(share * (1 << 64)) - (1 << 63))).cast("long"))
        fitted = few.select("v").orderBy(F.xxhash64("v")).limit(sample).toArrow()["v"].to_pylist()
        rows = _unit(_matrix(fitted))
        self.total = usable.count()
        self.tree = Tree()
        leaf_sample = max(LEAF_SAMPLE, round(len(rows) * LEAF_ROWS / max(1, self.total)))
        self.tree.grow(rows, leaf_sample, np.random.default_rng(SEED))
        placed = materialize(distinct.mapInArrow(_assign(self.tree), "v array<double>, ids array<long>, leaf long"), "leaves")
        # Leaves in order fill cells of BLOCK rows; a larger leaf is spread over as many as it needs. There are as many leaves as the sample allows.
        self.cells: dict[int, tuple[int, int]] = {}
        before = 0
        for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).orderBy("leaf").collect():
            self.cells[r["leaf"]] = (before // BLOCK, -(-r["n"] // BLOCK))
            before += r["n"]
        parts = vectors.sparkSession.createDataFrame([(leaf, *c) for leaf, c in self.cells.items()], "leaf long, first long, n long")
        self.rows = materialize(placed.join(parts, "leaf").select("v", "ids", "leaf", (F.col("first") + F.pmod(F.xxhash64("v"), F.col("n"))).alias("cell")), "cells")
        self.queries = usable
        self.visits = self._calibrated(recall)

    def _found(self, queries: DataFrame, visits: int) -> DataFrame:
        asked = materialize(queries.mapInArrow(_visits(self.tree, visits, self.cells), _ASKED), "visits")
        return _ranked(_in_cells(asked, self.rows, self.k), self.k)

    def _calibrated(self, recall: float) -> int:
        """Fewest visits after which the leaves hold the wanted share of the neighbours that a full comparison finds for some rows."""
        some = materialize(self.queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION), "calibration")
        truth = self._found(some, max(1, self.tree.leaves))
        home = self.rows.select(F.explode("ids").alias("vec_id"), "leaf")
        at = truth.join(home, "vec_id").join(some.withColumnRenamed("id", "query_id"), "query_id").select("v", "leaf")
        needed = np.sort([r["place"] for r in at.mapInArrow(_places(self.tree), "place long").collect()])  # CALIBRATION times k at most
        return int(needed[min(len(needed), int(np.ceil(recall * len(needed)))) - 1]) + 1 if len(needed) else 1

    def search(self, queries: DataFrame) -> DataFrame:
        """``query_id``, ``rank``, ``vec_id``, ``score`` for ``queries`` (``id``, ``v``): the nearest rows but the query's own, ties to the smaller id."""
        return self._found(queries.distinct(), self.visits)


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows found, by cosine, for each row whose id is divisible by ``every``.

    Rows with a NULL id, and vectors that are NULL, empty, zero, not finite, or of another size than most, take no part, neither as query nor as candidate.
    Repeated rows count once; different rows with the same vector are all candidates. Fewer than ``k`` candidates are all returned, none
    gives no row; other columns are ignored.
    """
    index = Index(vectors, k, id_col, vector_col, recall=recall)
    return index.search(index.queries.where(F.col("id") % every == 0))


def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
