"""Near duplicates by SimHash fingerprints, found by meeting in the middle between their Hamming balls."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import fresh, require, ship_by_value, table
from tallygrain.llm.graph import components
from tallygrain.session import materialize

ship_by_value(__name__)

RADIUS = 3
SEED = 42
BLOCKS = 4
#: Buckets above this size are left to the full balls, whose buckets cannot exceed 1 + 64 + 2016 fingerprints.
PAIRWISE = 128

_PAIR = "a long, b long"


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles: a bit is set if it is set in over half of their XXH64 values.

    A-Z are lower-cased; words are runs of characters other than ASCII white space; fewer words than ``shingle``
    give one shingle of them all; no word or NULL gives 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    values = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n).view(np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    table_of_bits = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.int64)
    for k in range(8):  # little-endian: byte k holds the bits 8k to 8k + 7
        ones[8 * k : 8 * k + 8] = np.bincount(values[:, k], minlength=256) @ table_of_bits
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > n))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id_col, fp)`` per row, ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_signed(fingerprint(t, shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], [id_col, "fp"])

    require(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Half the radius is 1.5, so one of four blocks is cleared: two fingerprints that differ in at most 3 bits differ in at
    most 2 outside a block that holds one of these bits (any block if they differ in fewer), and there the balls of
    radius 1 meet."""
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for block in range(BLOCKS):
            width = 64 // BLOCKS
            low = block * width
            base = prints & ~np.uint64(((1 << width) - 1) << low)
            flips = np.array([0] + [1 << b for b in range(64) if not low <= b < low + width], np.uint64)
            keys = ((base[:, None] ^ flips[None, :]) | np.uint64(block << low)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(prints.view(np.int64), len(flips)))], ["key", "fp"])


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plain balls: radius 1 for fingerprints with an even number of bits, 2 for the others. Pairs at odd distance have one of each
    kind; pairs at distance 2 are of one kind. ``far`` marks distance 2."""
    one = np.array([1 << b for b in range(64)], np.uint64)
    i, j = np.triu_indices(64, 1)
    two = one[i] | one[j]
    near = np.concatenate([np.zeros(1, np.uint64), one])
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        odd = np.bitwise_count(prints) % 2 == 1
        for some, flips, far in ((prints, near, False), (prints[odd], two, True)):
            for part in np.array_split(some, max(1, len(some) // 100)):
                keys = (part[:, None] ^ flips[None, :]).ravel()
                owners = np.repeat(part, len(flips)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), far)), pa.array(owners)], ["key", "far", "fp"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that the rows of a key (first column) stay together."""
    rest: list[np.ndarray] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        if len(columns[0]):
            cut = np.searchsorted(columns[0], columns[0][-1])
            rest = [c[cut:] for c in columns]
            if cut:
                yield [c[:cut] for c in columns]
    if rest:
        yield rest


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Pairs that keep the same nodes connected, at most one a node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    kept = []
    for a, b in np.unique(pairs, axis=0).tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def _as_batch(pairs: np.ndarray, alone: np.ndarray) -> pa.RecordBatch:
    a = np.concatenate([pairs[:, 0], alone])
    b = pa.array(np.concatenate([pairs[:, 1], alone]), mask=np.arange(len(a)) >= len(pairs))
    return pa.RecordBatch.from_arrays([pa.array(a), b], ["a", "b"])


def _verified(radius: int, pairwise: int):
    """Within buckets: verified pairs, thinned to a forest; fingerprints of buckets over ``pairwise`` with a NULL partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, crowded = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for key, prints in _runs(batches):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            size = np.repeat(sizes, sizes)
            crowded = np.unique(np.concatenate([crowded, prints[size > pairwise]]))
            at, pairs = np.flatnonzero((size > 1) & (size <= pairwise)), []
            lag = 1
            while len(at):
                at = at[at + lag < len(key)]
                at = at[key[at + lag] == key[at]]
                a, b = prints[at], prints[at + lag]
                close = (np.bitwise_count((a ^ b).view(np.uint64)) <= radius) & (a != b)
                pairs.append(np.stack([np.minimum(a, b)[close], np.maximum(a, b)[close]], axis=1))
                lag += 1
            found = np.concatenate([found, *pairs])
            if len(found) + len(crowded) > 500_000:
                yield _as_batch(_forest(found), crowded)
                found, crowded = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        yield _as_batch(_forest(found), crowded)

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within buckets of plain balls: a fingerprint within 1 of the key is within 3 of every other one, so it ties them all."""
    none = np.empty(0, np.int64)
    for key, far, prints in _runs(batches):
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        first = np.repeat(starts, sizes)
        tied = ~far[first] & (prints != prints[first])
        yield _as_batch(_forest(np.stack([prints[first][tied], prints[tied]], axis=1)), none)


def links(prints: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints ``fp`` that connect exactly what pairs within ``RADIUS`` connect.

    Variants are shuffled by key and sorted, colliding pairs verified run by run. Fingerprints of crowded buckets go through plain balls
    as well, where a bucket is bounded by the size of a ball and no pair needs a comparison.
    """
    keyed = prints.select("fp").mapInArrow(_variants, "key long, fp long")
    found = materialize(keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_verified(RADIUS, pairwise), _PAIR), "links")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    balls = crowded.mapInArrow(_balls, "key long, far boolean, fp long")
    stars = balls.repartition("key").sortWithinPartitions("key", "far", "fp").mapInArrow(_stars, _PAIR)
    return found.where("b is not null").unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id_col, fp, component_id)`` per row of ``docs``: its fingerprint and the smallest id in its component.

    Documents whose fingerprints differ in at most 3 bits are linked. Empty, blank and NULL texts have fingerprint 0 and are linked
    like any other; rows with a NULL id take part and get the smallest id of their component (NULL if it has none); repeated rows stay. An
    empty table gives an empty result. Other columns are ignored. Copies share a fingerprint and count once: only distinct
    fingerprints are shuffled as variants.
    """
    marked = materialize(with_fingerprints(docs, id_col, text_col, shingle), "prints")
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    roots = components(links(distinct))
    inside = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "least")
    of_root = inside.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = materialize(inside.join(of_root, "root").select(F.col("fp").alias("k"), F.col("component_id").alias("c")), "moved")
    named = distinct.join(moved, F.col("fp") == F.col("k"), "left").select(F.col("fp").alias("k"), F.coalesce("c", "least").alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("k")).select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows without an id or without a word stay as they are.

    A text without a word has no content to repeat, so such rows are not taken for copies of each other.
    """
    groups = near_duplicates(docs.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]")), id_col, text_col)
    name = fresh(docs, "gone")
    gone = materialize(groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(name)).distinct(), "gone")
    return docs.join(gone, docs[id_col] == gone[name], "left_anti")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
