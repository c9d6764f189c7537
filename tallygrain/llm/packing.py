"""Packing documents into training sequences: linear grouping of large pieces, configurations, best fit for the rest."""

from __future__ import annotations

import bisect
import functools
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

SEQUENCE = 2048
END_ID = 0
#: Pieces longer than this part of a sequence are large; their lengths are rounded up within so many groups of equal size.
LARGE = 1 / 3
GROUPS = 32
#: Pieces of one length that a task numbers at once, about.
BUCKET_ROWS = 20_000

#: Runs of white space from this length on.
LONG_RUN = 10_000

_PIECE = "piece int, start long, length long, ids_crc32 long"


# ---- tokens ----------------------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Function from a text to its ids under the byte-level BPE in ``path`` (a ``tokenizers`` file), without special tokens added.

    The merges run in tiktoken, which gives the same ids several times faster; texts that hold the name of an added token go through
    tokenizers itself, and so do texts with very long runs of white space, which tiktoken's splitter cannot take.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}
    back = {c: b for b, c in chars.items()}
    added = [t["content"] for t in spec["added_tokens"]]
    ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    # Fixed value: the split of byte-level BPE before its merges.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    long_run = re.compile(rf"\s{{{LONG_RUN}}}")
    fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)

    def ids(text: str) -> list[int]:
        if any(a in text for a in added) or (len(text) >= LONG_RUN and long_run.search(text)):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: all but the first are full."""
    first = (n - 1) % size + 1
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``piece``, ``start``, ``length`` and ``ids_crc32`` per piece of each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*ids_of(text or ""), END_ID], "<u4")
                for k, (s, n) in enumerate(cut(len(ids), size)):
                    row.append(i)
                    number.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], [id_col, "piece", "start", "length", "ids_crc32"])

    require(docs, id_col, text_col)
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {_PIECE}")


# ---- plan: from the number of pieces of each length, whose size depends on the sequence only -----------------------


class Placed(NamedTuple):
    """Pieces of one length, by their number in it: that with number ``r`` goes to sequence ``first + (r - low) % sequences``."""

    length: int
    low: int
    high: int
    first: int
    sequences: int


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations of few sizes and how often each is used, rounded down from the linear program's optimum.

    Columns are generated: prices of the sizes come from the basis, the best new configuration from a knapsack over the capacity.
    """
    m = len(sizes)
    if not m:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    amount = np.array([d / (capacity // s) for d, s in zip(demand, sizes)])
    size_at = np.array(sizes)
    for _ in range(40 * m):
        price = np.linalg.solve(basis.T, np.ones(m))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(size_at.min()), capacity + 1):
            fits = np.flatnonzero(size_at <= c)
            value = best[c - size_at[fits]] + price[fits]
            k = int(value.argmax())
            best[c], pick[c] = (value[k], fits[k]) if value[k] > best[c - 1] + 1e-12 else (best[c - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if pick[c] < 0:
                c -= 1
            else:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        change = np.linalg.solve(basis, column)
        rising = change > 1e-9
        step = np.where(rising, np.maximum(amount, 0) / np.where(rising, change, 1), np.inf)
        out = int(step.argmin())
        amount = amount - step[out] * change
        amount[out], basis[:, out] = step[out], column
    return [([round(a) for a in basis[:, i]], int(np.floor(amount[i] + 1e-6))) for i in range(m) if amount[i] >= 1 - 1e-6]


def plan(histogram: dict[int, int], capacity: int = SEQUENCE, large: float = LARGE, groups: int = GROUPS) -> tuple[list[Placed], int]:
    """Where the pieces of each length go, and the number of sequences."""
    out: list[Placed] = []
    used = dict.fromkeys(histogram, 0)
    sequences = 0
    if full := histogram.get(capacity, 0):
        out.append(Placed(capacity, 0, full, 0, full))
        sequences = full
    big = [(s, n) for s, n in sorted(histogram.items(), reverse=True) if large * capacity < s < capacity]
    each = max(1, -(-sum(n for _, n in big) // groups))
    # Groups of equal cardinality from the longest on; a group counts as its longest length.
    runs: list[list[list[int]]] = []
    left = 0
    for s, n in big:
        while n:
            if not left:
                runs.append([])
                left = each
            k = min(n, left)
            runs[-1].append([s, k])
            n, left = n - k, left - k
    sizes = [r[0][0] for r in runs]
    # Equal sizes are one size of the program.
    merged: dict[int, list[list[int]]] = {}
    for s, r in zip(sizes, runs):
        merged.setdefault(s, []).extend(r)
    sizes = list(merged)
    gaps: dict[int, list[tuple[int, int]]] = {}
    for pattern, times in configurations(sizes, [sum(n for _, n in merged[s]) for s in sizes], capacity):
        # Real lengths of each place over the pattern's sequences, as runs. The last place, of the smallest size, stays open: rounding has
        # made it a little too large for its group, and best fit finds the piece that closes it exactly.
        edges, places = {0, times}, []
        chosen = [s for s, count in zip(sizes, pattern) for _ in range(count)]
        for s in chosen[: max(1, len(chosen) - 1)]:
            taken, at = [], 0
            while at < times and merged[s]:
                length, n = merged[s][0]
                k = min(n, times - at)
                taken.append((at, at + k, length))
                merged[s][0][1] -= k
                if not merged[s][0][1]:
                    merged[s].pop(0)
                out.append(Placed(length, used[length], used[length] + k, sequences + at, k))
                used[length] += k
                at += k
            places.append(taken)
            edges |= {x for a, b, _ in taken for x in (a, b)}
        cuts = sorted(edges)
        for a, b in zip(cuts, cuts[1:]):
            fill = sum(length for taken in places for x, y, length in taken if x <= a < y)
            gaps.setdefault(capacity - fill, []).append((sequences + a, b - a))
        sequences += times
    # What is left, the longest first, goes where it fits best.
    order = sorted(gaps)
    for length in sorted(histogram, reverse=True):
        n = histogram[length] - used[length]
        while n and length < capacity:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                fresh = -(-n // (capacity // length))
                gap, start, many = capacity, sequences, fresh
                sequences += fresh
            else:
                gap = order[at]
                start, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
            fits = gap // length
            whole = min(many, n // fits)
            parts = [(start, whole, fits)] if whole else [(start, 1, n)]
            took = max(whole, 1)
            if took < many:
                parts.append((start + took, many - took, 0))
            for first, count, per in parts:
                if per:
                    out.append(Placed(length, used[length], used[length] + count * per, first, count))
                    used[length] += count * per
                    n -= count * per
                rest = gap - per * length
                if rest:
                    if rest not in gaps:
                        bisect.insort(order, rest)
                    gaps.setdefault(rest, []).append((first, count))
    return out, sequences


# ---- placing ----------------------------------------------------------------------------------------------------


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` per piece.

    A document's tokens are its ids and one ``END_ID``; NULL and empty texts are that one token. Only documents of more than ``size`` tokens
    are cut; texts of any length are read whole. Repeated rows are packed as often as they are there, ties of length in the order of ids; an empty table gives an empty result; other
    columns are ignored.

    The driver sees one count per length (``size`` of them at most) and plans where numbers of pieces go. Pieces are numbered per length
    within hashed buckets, whose counts say where each starts, so that one length may hold any share of the rows.
    """
    cut_up = materialize(pieces(docs, tokenizer, size, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    placed, _ = plan(counts, size)
    spark = docs.sparkSession
    buckets = max(1, -(-total // bucket_rows))
    keyed = cut_up.withColumn("bucket", F.pmod(F.xxhash64(F.col(id_col), "piece"), F.lit(buckets)))
    along = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(F.col("length").alias("l"), F.col("bucket").alias("k"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "ids_crc32")
    numbered = keyed.withColumn("r", F.row_number().over(inside) - 1).join(starts, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("k"))).withColumn("r", F.col("r") + F.col("before"))
    rows: dict[int, list] = {}
    for p in placed:
        rows.setdefault(p.length, []).append((p.low, p.high, p.first, p.sequences))
    kind = "l long, places array<struct<low:long,high:long,first:long,sequences:long>>"
    where = spark.createDataFrame(sorted(rows.items()), kind)  # as many rows as there are lengths
    place = F.filter("places", lambda p: (F.col("r") >= p["low"]) & (F.col("r") < p["high"]))[0]
    found = numbered.drop("l").join(F.broadcast(where), F.col("length") == F.col("l")).withColumn("place", place)
    sequence = F.col("place.first") + F.pmod(F.col("r") - F.col("place.low"), F.col("place.sequences"))
    within = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), id_col, "piece", "r").rowsBetween(Window.unboundedPreceding, -1)
    laid = found.withColumn("sequence_id", sequence).withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    return laid.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())
