"""Near duplicates by the Jaccard similarity of their word shingles: SimHash fingerprints that ball hashing brings together, then MinHash bands
for what these cannot reach, propose pairs; the shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import fresh, require, ship_by_value
from tallygrain.llm.graph import components
from tallygrain.llm.simhash_dedup import fingerprint
from tallygrain.llm.simhash_dedup import links as ball_links
from tallygrain.llm.url_filter import BITS_PER_KEY, MAX_WORDS, build, encode
from tallygrain.session import materialize

ship_by_value(__name__)

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at SIMILARITY shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, which is 1.5e-5.
BANDS, ROWS = 28, 5
#: Buckets of more different texts are not compared pair by pair.
CROWD = 64

_MULTIPLY = np.array([xxhash.xxh64_intdigest(str(i), 1) | 1 for i in range(BANDS * ROWS)], np.uint64)
_ADD = np.array([xxhash.xxh64_intdigest(str(i), 2) for i in range(BANDS * ROWS)], np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 values of the word shingles.

    A-Z are lower-cased; words are runs of characters other than ASCII white space; fewer words than ``size`` give one shingle of them all.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64))


def bands(values: np.ndarray) -> list[int]:
    """A signed 64-bit key a band, of the ROWS least values under as many orders."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 512):
        least = np.minimum(least, (values[None, at : at + 512] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1))
    keys = [xxhash.xxh64_intdigest(x.tobytes(), band) for band, x in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        sets = [shingles(t) for t in texts]
        prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        columns = [batch.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(bands, sets)), pa.list_(pa.int64())), pa.array(prints)]
        yield pa.RecordBatch.from_arrays(columns, ["s", "n", "keys", "fp"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t).view(np.int64) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["s", "set"])


def _row(row_id: Column, name: Column) -> Column:
    """128 bits that stand for the id and text of a row; NULL without an id."""
    return F.unhex(F.md5(F.concat(row_id.cast("string").cast("binary"), F.lit(":").cast("binary"), name)))


def _name(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


def _among(keys: DataFrame, n: int, key: Column, seed: int) -> Column | None:
    """Whether ``key`` may be one of the ``n`` ``keys``, by a Bloom filter in the plan; None if they are too many for one."""
    return encode(keys, n, seed).test(key) if n * BITS_PER_KEY <= 64 * MAX_WORDS else None


def _sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(s, set)`` of the texts in ``wanted`` (``w``); the others are held back where they are read while a Bloom filter can do that."""
    maybe = _among(wanted.select(F.col("w").alias("key")), wanted.count(), F.col("s"), 13000)
    found = texts if maybe is None else texts.where(maybe)
    distinct = found.mapInArrow(_sets, "s binary, set array<long>").join(wanted.hint("merge"), F.col("s") == F.col("w"), "left_semi")
    return materialize(distinct.dropDuplicates(["s"]), "sets")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` ``(a, b)`` whose shingle sets have the similarity; the sets are made anew for the texts in question only."""
    pairs = materialize(pairs, "candidates")
    wanted = materialize(pairs.select(F.col("a").alias("w")).unionByName(pairs.select(F.col("b").alias("w"))).distinct(), "wanted")
    sets = _sets_of(texts, wanted)
    both = pairs.join(sets.select(F.col("s").alias("a"), F.col("set").alias("a_set")), "a").join(sets.select(F.col("s").alias("b"), F.col("set").alias("b_set")), "b")
    common = F.size(F.array_intersect("a_set", "b_set"))
    return materialize(both.where(common >= F.lit(similarity) * (F.size("a_set") + F.size("b_set") - common)).select("a", "b"), "links")


def _may(n: Column, m: Column, similarity: float) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return F.least(n, m) >= F.lit(similarity) * F.greatest(n, m)


def _by_rarity(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``(s, shingle, n, count, at)`` of the texts ``s`` of ``members``: their ``n`` shingles, numbered from the rarest among them."""
    sets = _sets_of(texts, members.select(F.col("s").alias("w")))
    shingle = materialize(sets.select("s", F.size("set").cast("long").alias("n"), F.explode("set").alias("shingle")), "shingles")
    counts = shingle.groupBy("shingle").agg(F.count("*").alias("count"))
    along = Window.partitionBy("s").orderBy("count", "shingle")  # a text's own shingles
    return materialize(shingle.join(counts, "shingle").withColumn("at", F.row_number().over(along)), "by-rarity")


def _rare_pairs(placed: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of texts with different ``root`` in ``roots`` (``s``, ``root``) that can have the similarity, without bands.

    With shingles in one order, the rarest first, two sets of the similarity share one among the first of each, those that the others
    cannot make up for. At the first that they share, the shorter rest of the two still bounds what is common; a pair that fails this
    wherever it meets is not similar. What a family of texts has in common is not rare and so brings few pairs together.
    """
    first = placed.where((F.col("count") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1))
    rare = materialize(first.join(roots, "s").select("shingle", "s", "n", "root", (F.col("n") - F.col("at") + 1).alias("rest")), "rare")
    left, right = (rare.select("shingle", *[F.col(c).alias(f"{x}_{c}") for c in ("s", "n", "root", "rest")]) for x in "ab")
    needed = F.lit(similarity / (1 + similarity)) * (F.col("a_n") + F.col("b_n")) - 1e-6
    met = left.join(right, "shingle").where((F.col("a_s") < F.col("b_s")) & (F.col("a_root") != F.col("b_root")) & (F.least("a_rest", "b_rest") >= needed))
    return met.select(F.col("a_s").alias("a"), F.col("b_s").alias("b")).distinct()


def _crowd_links(crowded: DataFrame, links: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs that, with ``links``, connect what similar pairs connect among the texts of crowded buckets (``key``, ``s``, ``n``, ``root``).

    A family of changed copies may be far from each other and yet near what they were made from: each bucket's texts are
    compared with the one whose shingles are the most common, then texts still apart are paired by rare shingles.
    """
    placed = _by_rarity(crowded.select("s").distinct(), texts)
    common = placed.groupBy("s").agg(F.avg("count").alias("common"))
    hubs = crowded.join(common, "s").groupBy("key").agg(F.max(F.struct("common", "s", "n", "root")).alias("hub"))
    met = crowded.join(hubs, "key").where((F.col("root") != F.col("hub.root")) & _may(F.col("n"), F.col("hub.n"), similarity))
    stars = _verified(met.select(F.col("hub.s").alias("a"), F.col("s").alias("b")).distinct(), texts, similarity)
    roots = components(links.unionByName(stars)).select(F.col("node").alias("k"), "root")
    now = crowded.select("s").distinct().join(roots, F.col("s") == F.col("k"), "left").select("s", F.coalesce("root", "s").alias("root"))
    return stars.unionByName(_verified(_rare_pairs(placed, materialize(now, "crowd-roots"), similarity), texts, similarity))


def _by_fingerprint(marked: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of the similarity among texts (``s``, ``n``, ``fp``) whose SimHash fingerprints are equal or linked by ball hashing.

    The texts of a fingerprint are compared with the least of them, linked fingerprints by the least text of each, so that a crowd costs a pair a text.
    """
    prints = materialize(marked.groupBy("fp").agg(F.min(F.struct("s", "n")).alias("least")).select("fp", F.col("least.s").alias("least"), F.col("least.n").alias("least_n")), "prints")
    same = marked.join(prints, "fp").where(F.col("s") != F.col("least")).select(F.col("least").alias("a"), F.col("s").alias("b"), F.col("least_n").alias("a_n"), F.col("n").alias("b_n"))
    left, right = (prints.select(F.col("fp").alias(x), F.col("least").alias(f"{x}_s"), F.col("least_n").alias(f"{x}_n")) for x in "ab")
    near = ball_links(prints).join(left, "a").join(right, "b").select(F.col("a_s").alias("a"), F.col("b_s").alias("b"), "a_n", "b_n")
    return _verified(same.unionByName(near).where(_may(F.col("a_n"), F.col("b_n"), similarity)).select("a", "b").distinct(), texts, similarity)


def links(texts: DataFrame, similarity: float = SIMILARITY, crowd: int = CROWD) -> DataFrame:
    """Pairs ``(a, b)`` that connect what pairs of the similarity connect, among different texts ``s``, ``text`` with near fingerprints or a common band.

    Fingerprints of ``simhash_dedup`` come first: what ball hashing links and the shingle sets confirm is not compared again. Texts of the
    similarity differ in ten bits on average, so most links are beyond three bits, and bands bring these texts together.

    In each bucket all texts are first compared with the least one, so that a crowd of near copies costs a pair a text. What this leaves in different
    components is compared pair by pair in buckets of up to ``crowd`` texts; the texts of larger ones are compared with the
    most central one, then by their rare shingles, which is exact. Buckets are counted before their rows meet, and no bucket is capped.
    """
    kinds = "s binary, n long, keys array<long>, fp long"
    marked = materialize(texts.mapInArrow(_keys, kinds).groupBy("s").agg(*[F.first(c).alias(c) for c in ("n", "keys", "fp")]), "marked")
    near = _by_fingerprint(marked, texts, similarity)
    family = materialize(components(near).select(F.col("node").alias("f"), F.col("root").alias("family")), "families")
    keyed = marked.select("s", "n", F.explode("keys").alias("key"))
    buckets = materialize(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    maybe = _among(buckets.select("key"), buckets.count(), F.col("key"), 15000)
    joined = (keyed if maybe is None else keyed.where(maybe)).join(buckets.hint("merge"), "key").join(family, F.col("s") == F.col("f"), "left")
    met = materialize(joined.select("key", "s", "n", "size", F.coalesce("family", "s").alias("family")), "met")
    least = met.groupBy("key").agg(F.min(F.struct("s", "n", "family")).alias("l")).select("key", F.col("l.s").alias("least"), F.col("l.n").alias("least_n"), F.col("l.family").alias("least_family"))
    shared = materialize(met.join(least, "key"), "shared")
    apart = (F.col("family") != F.col("least_family")) & _may(F.col("n"), F.col("least_n"), similarity)
    stars = shared.where(apart).select(F.col("least").alias("a"), F.col("s").alias("b")).distinct()
    starred = _verified(stars, texts, similarity)
    # Families stand for what made them: they are contracted already.
    roots = materialize(components(family.select(F.col("f").alias("a"), F.col("family").alias("b")).unionByName(starred)).select(F.col("node").alias("k"), "root"), "roots")
    members = materialize(shared.join(roots, shared["s"] == roots["k"], "left").select("key", "s", "n", "least", "size", F.coalesce("root", "s").alias("root")), "members")
    apart = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    open_ = materialize(members.join(apart, "key", "left_semi"), "open")
    few = open_.where(F.col("size") <= crowd)
    left = few.select("key", "least", F.col("s").alias("a"), F.col("n").alias("a_n"), F.col("root").alias("a_root"))
    right = few.select("key", F.col("s").alias("b"), F.col("n").alias("b_n"), F.col("root").alias("b_root"))
    other = (F.col("a") < F.col("b")) & (F.col("a") != F.col("least")) & (F.col("a_root") != F.col("b_root")) & _may(F.col("a_n"), F.col("b_n"), similarity)
    paired = _verified(left.join(right, "key").where(other).select("a", "b").distinct(), texts, similarity)
    first = near.unionByName(starred).unionByName(paired)
    crowded = open_.where(F.col("size") > crowd).select("key", "s", "n", "root")
    known = roots.select(F.col("k").alias("a"), F.col("root").alias("b")).unionByName(paired)
    return first if crowded.isEmpty() else first.unionByName(_crowd_links(crowded, known, texts, similarity))


def without(rows: DataFrame, key: Column, universe: DataFrame, name: str) -> DataFrame:
    """``rows`` whose ``key`` is not listed in ``universe`` (distinct ``key``, ``listed``), which holds the keys of all rows but NULL ones.

    A cascade of Bloom filters tells that where the rows are read, without moving them; listed keys beyond its bounds are joined.
    """
    sizes = universe.agg(F.count_if("listed").alias("listed"), F.count("*").alias("all")).first()
    if max(sizes["listed"], sizes["all"] // 50) * BITS_PER_KEY <= 64 * MAX_WORDS:  # a level lets fewer than a fiftieth of the others through
        cascade = build(universe)
        return rows.where(~F.coalesce(cascade.contains(key), F.lit(False)))
    listed = universe.where("listed").select(F.col("key").alias(name))
    return rows.join(listed, key == F.col(name), "left_anti")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows without an id or without a word stay as they are.

    Texts are linked if the Jaccard similarity of their sets of five-word shingles is at least ``similarity``. Rows with a NULL id link
    others; repeated rows share their fate; rows of one id with different texts are judged one by one. An empty table gives an empty result.
    """
    require(docs, id_col, text_col)
    rows = docs.where(F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(F.col(id_col).alias("id"), _name(F.col(text_col)).alias("s"), F.col(text_col).alias("text"))
    named = materialize(rows.groupBy("id", "s").agg(F.lit(1).alias("one")), "named")
    least = named.groupBy("s").agg(F.min("id").alias("least"))
    inside = materialize(least.join(components(links(rows.select("s", "text"), similarity)), F.col("s") == F.col("node"), "left").select("s", "least", F.coalesce("root", "s").alias("root")), "inside")
    of_root = inside.groupBy("root").agg(F.min("least").alias("kept"))
    kept = inside.join(of_root, "root").select(F.col("s").alias("k"), "kept")
    judged = named.where("id is not null").join(kept, F.col("s") == F.col("k")).select(_row(F.col("id"), F.col("s")).alias("key"), (F.col("id") != F.col("kept")).alias("listed"))
    own = F.when(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), _row(F.col(id_col), _name(F.col(text_col))))
    return without(docs, own, materialize(judged, "judged"), fresh(docs, "gone"))
