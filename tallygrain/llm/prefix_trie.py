"""Prefix trie of conversations: an Euler tour of enter and exit arcs, ranked on the cluster, gives sums over subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

#: Arcs that a task ranks among themselves at once, about.
ARCS_PER_TASK = 500_000
#: Ids that one string of the digests holds at most.
IDS_PER_CHUNK = 50_000
#: Of conversation c, this many turns at most come from conversation c - c % FAMILY in the query's rebuilt conversations.
FAMILY, HEADS = 100, 6

_TERMS = ["t0", "t1", "t2"]


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, Column], label: str) -> DataFrame:
    """``df`` with running sums along ``order`` within ``by``, the row itself included; order and group columns are not NULL.

    Rows are dealt by ranges of (by, order), so that a group of any size is divided; sums of the parts of a group that come before are
    added to those within a part. Only equal keys stay together, and for equal keys the result would depend on chance: make them unique.
    """
    held = [f"_sum{i}" for i in range(len(sums))]
    placed = materialize(df.withColumns(dict(zip(held, sums.values()))).repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), label)
    inside = Window.partitionBy("_part", *by)
    along = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_in{c}": F.sum(c).over(along) for c in held})
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part", *by).agg(*[F.sum(c).alias(c) for c in held])
    starts = parts.select("_part", *by, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in held])
    joined = local.join(starts.where(" or ".join(f"_before{c} != 0" for c in held)), ["_part", *by], "left")
    done = joined.withColumns({name: F.col(f"_in{c}") + F.coalesce(f"_before{c}", F.lit(0)) for name, c in zip(sums, held)})
    return done.drop("_part", *held, *[f"_in{c}" for c in held], *[f"_before{c}" for c in held])


# ---- nodes -----------------------------------------------------------------------------------------------------------


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``c``, ``pos`` (from 1), ``digest`` and ``chars`` per turn: texts are read once and travel as SHA-256 digests.

    Turns are ordered by ``turn_col``, NULL first, equal ones by digest. NULL roles and texts are empty; rows without an id take no part.
    """
    require(conversations, id_col, turn_col, role_col, text_col)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    distinct = rows.groupBy("c", F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0).cast(rows.schema["turn"].dataType)).alias("turn"), "digest").agg(F.count("*").alias("n"), F.first("chars").alias("chars"))
    last = running(distinct, ["c"], ["dated", "turn", "digest"], {"last": F.col("n")}, "turns")
    return last.select("c", F.explode(F.sequence(F.col("last") - F.col("n") + 1, F.col("last"))).alias("pos"), "digest", "chars")


def nodes_of(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes and the ``ends``, a row a conversation: ``(node, c)``.

    ``turns`` has ``c``, ``depth`` (from 1 on, without gaps), ``digest``, ``chars``; ``lengths`` has every ``c`` with its number of turns
    ``length``, 0 included. A prefix is named by its depth and by three sums of 64-bit hashes of its digests and their places. Nodes have ``node``, ``parent``,
    ``conv_id`` (smallest member), ``depth``, ``n_convs``, ``chars``.
    """
    term = [F.xxhash64(F.lit(i), "digest", "depth").cast("decimal(20,0)") for i in range(len(_TERMS))]
    sums = running(turns, ["c"], ["depth"], dict(zip(_TERMS, term)), "prefixes")

    def name(depth: Column, parts: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(":", depth.cast("long"), *[p.cast("decimal(38,0)") for p in parts]).cast("binary")))

    at = [F.col(t) for t in _TERMS]
    own = name(F.col("depth"), at)
    parent = name(F.col("depth") - 1, [a - t for a, t in zip(at, term)])
    members = materialize(sums.select("c", "depth", own.alias("node"), parent.alias("parent"), "chars"), "members")
    top = name(F.lit(0), [F.lit(0)] * len(_TERMS))
    inner = members.groupBy("node").agg(F.first("parent").alias("parent"), F.min("c").alias("conv_id"), F.first("depth").cast("long").alias("depth"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"))
    root = lengths.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(top.alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("chars"))
    last = members.join(lengths.select(F.col("c").alias("k"), "length"), (F.col("c") == F.col("k")) & (F.col("depth") == F.col("length"))).select("node", "c")
    ends = last.unionByName(lengths.where("length = 0").select(top.alias("node"), "c"))
    return inner.unionByName(root), ends


# ---- tour ------------------------------------------------------------------------------------------------------------


def numbered(nodes: DataFrame) -> DataFrame:
    """Nodes with ``num`` (from 0, by smallest member and depth), ``parent_num``, ``parent_conv_id``, ``n_children``, ``first_child`` and ``next_sibling``.

    Siblings follow each other by number. A parent may have any number of children: they are dealt by ranges.
    """
    counted = running(nodes, [], ["conv_id", "depth"], {"upto": F.lit(1).cast("long")}, "numbers")
    named = materialize(counted.withColumn("num", F.col("upto") - 1).drop("upto"), "numbered")
    above = named.select(F.col("node").alias("k"), F.col("num").alias("parent_num"), F.col("conv_id").alias("parent_conv_id"))
    below = named.join(above, F.col("parent") == F.col("k")).select("num", "parent_num", "parent_conv_id")
    children = materialize(running(below, [], ["parent_num", "num"], {"place": F.lit(1).cast("long")}, "siblings"), "children")
    following = children.select((F.col("place") - 1).alias("p"), F.col("num").alias("next_sibling"), F.col("parent_num").alias("q"))
    placed = children.join(following, (F.col("place") == F.col("p")) & (F.col("parent_num") == F.col("q")), "left").select(F.col("num").alias("n"), "parent_num", "parent_conv_id", "next_sibling")
    of_parent = children.groupBy(F.col("parent_num").alias("m")).agg(F.count("*").alias("n_children"), F.min("num").alias("first_child"))
    out = named.join(placed, F.col("num") == F.col("n"), "left").join(of_parent, F.col("num") == F.col("m"), "left")
    return out.drop("n", "m").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))


def tour(nodes: DataFrame) -> DataFrame:
    """Arcs ``arc`` and ``next``: node k is entered by arc 2k and left by arc 2k + 1; the last one has no next."""
    enter = F.coalesce(2 * F.col("first_child"), 2 * F.col("num") + 1)
    leave = F.coalesce(2 * F.col("next_sibling"), 2 * F.col("parent_num") + 1)
    arcs = F.array(F.struct((2 * F.col("num")).alias("arc"), enter.alias("next")), F.struct((2 * F.col("num") + 1).alias("arc"), leave.alias("next")))
    return nodes.select(F.inline(arcs))


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a task: for each arc the first one along the tour that is not in the task, and the number of steps to it."""
    table_of = [b for b in batches if b.num_rows]
    if not table_of:
        return
    arc, after = (np.concatenate([b.column(i).fill_null(-1).to_numpy() for b in table_of]) for i in (0, 1))
    order = np.argsort(arc)
    arc, after = arc[order], after[order]
    at = np.minimum(np.searchsorted(arc, after), len(arc) - 1)
    here = arc[at] == after
    jump = np.where(here, at, np.arange(len(arc)))  # the last arc of a stretch stays where it is
    steps = here.astype(np.int64)
    while True:
        further = steps[jump]
        if not further.any():
            break
        steps, jump = steps + further, jump[jump]
    out = after[jump]
    yield pa.RecordBatch.from_arrays([pa.array(arc), pa.array(out, mask=out < 0), pa.array(steps + 1)], ["arc", "next", "steps"])


def ranked(arcs: DataFrame, total: int, arcs_per_task: int = ARCS_PER_TASK) -> DataFrame:
    """``(arc, rank)``: places along the list ``arcs`` (``arc``, ``next``) of ``total`` arcs with numbers from 0, the first one 0.

    Arcs with near numbers are brought together and follow their pointers within their task, so that each points out of it. What others point
    to, the few entries of tasks, is a shorter list, ranked by pointer jumping: as many rounds as the logarithm of its length. An arc is then as
    far from the end as the entry it points to, and its steps.
    """
    spark = arcs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // arcs_per_task))
    width = max(1, -(-total // tasks))
    dealt = arcs.withColumn("part", F.floor(F.col("arc") / width)).repartition(tasks, "part").select("arc", "next")
    short = materialize(dealt.mapInArrow(_shortened, "arc long, next long, steps long"), "short")
    entries = short.where("next is not null").select(F.col("next").alias("e")).distinct()
    jumps = materialize(short.join(entries, F.col("arc") == F.col("e"), "left_semi"), "jumps")
    while jumps.where("next is not null").limit(1).count():
        on = jumps.select(F.col("arc").alias("k"), F.col("next").alias("next_"), F.col("steps").alias("more"))
        there = jumps.join(on, F.col("next") == F.col("k"), "left")
        jumps = materialize(there.select("arc", F.col("next_").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "jumps")
    left = jumps.select(F.col("arc").alias("k"), F.col("steps").alias("more"))
    return short.join(left, F.col("next") == F.col("k"), "left").select("arc", (F.lit(total) - F.col("steps") - F.coalesce("more", F.lit(0))).alias("rank"))


# ---- digests of ids ------------------------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(node, c)`` to strings of IDS_PER_CHUNK ids at most, with the first one."""
    node, ids = None, []

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

    for batch in batches:
        for key, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (key != node or len(ids) == IDS_PER_CHUNK):
                yield chunk()
                ids = []
            node = key
            ids.append(c)
    if ids:
        yield chunk()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to the SHA-256 of a node's ids, fed chunk by chunk."""
    node, sha = None, None
    nodes, out = [], []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key == node:
                sha.update(b"," + text.encode())
            else:
                if sha:
                    nodes.append(node)
                    out.append(sha.hexdigest())
                node, sha = key, hashlib.sha256(text.encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(out)], ["node", "sha"])
            nodes, out = [], []
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([*nodes, node], pa.binary()), pa.array([*out, sha.hexdigest()])], ["node", "sha"])


def ids_sha256(ends: DataFrame) -> DataFrame:
    """``(node, sha)``: SHA-256 of the ascending ids of each node, joined by commas. The ids of a node become strings in parallel; only the
    digest itself, which is sequential, runs through them in one task, without holding them."""
    chunks = ends.repartitionByRange("node", "c").sortWithinPartitions("node", "c").mapInArrow(_chunks, "node binary, first long, ids string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node binary, sha string")


# ---- operator --------------------------------------------------------------------------------------------------------


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node of the trie of conversations: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` and ``lengths`` are as of ``nodes_of``. A node is named by its smallest member and its depth. ``n_leaves`` and
    ``saved_tokens`` are differences of prefix sums along the Euler tour, at the places of a node's two arcs. No conversations give no node, not even a root.
    """
    nodes, ends = nodes_of(turns, lengths)
    nodes = materialize(numbered(nodes), "nodes")
    total = 2 * nodes.count()
    places = ranked(tour(nodes), total)
    weights = nodes.select((2 * F.col("num")).alias("a"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    weighed = places.join(weights, F.col("arc") == F.col("a"), "left").select("arc", "rank", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved"))
    summed = running(weighed, [], ["rank"], {"leaves": F.col("leaf"), "saves": F.col("saved")}, "sums")
    entered = F.col("arc") % 2 == 0

    def between(upto: str, own: str) -> Column:
        return F.sum(F.when(entered, F.col(own) - F.col(upto)).otherwise(F.col(upto)))

    of_node = summed.groupBy(F.floor(F.col("arc") / 2).alias("k")).agg(between("leaves", "leaf").alias("n_leaves"), between("saves", "saved").alias("saved_tokens"))
    shas = ids_sha256(ends).select(F.col("node").alias("at"), "sha")
    joined = nodes.join(of_node, F.col("num") == F.col("k")).join(shas, F.col("node") == F.col("at"), "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", empty).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """``trie`` of conversations as they are; columns and orders as of ``turns_of``."""
    turns = materialize(turns_of(conversations, **columns), "conversations")
    return trie(turns.withColumnRenamed("pos", "depth"), turns.groupBy("c").agg(F.count("*").alias("length")))


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``turns`` and ``lengths`` of the conversations in which c starts with the first h turns of c - c % ``family`` and goes on with its own
    after its first h, where h is the CRC-32 of its decimal id modulo ``heads``."""
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % heads).cast("long")
    base = F.col("c") - F.col("c") % family
    counts = turns.groupBy("c").agg(F.count("*").alias("own"))
    of_base = counts.where(F.col("c") % family == 0).select(F.col("c").alias("b"), F.col("own").alias("there"))
    taken = counts.withColumns({"h": h, "base": base}).join(of_base, F.col("base") == F.col("b"), "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    convs = materialize(taken.select("c", "base", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    first = turns.where((F.col("c") % family == 0) & (F.col("pos") < heads)).select(F.col("c").alias("b"), F.col("pos").alias("depth"), "digest", "chars")
    head = convs.join(first, (F.col("base") == F.col("b")) & (F.col("depth") <= F.col("k"))).select("c", "depth", "digest", "chars")
    own = turns.where(F.col("pos") > h).join(convs.select(F.col("c").alias("d"), "k"), F.col("c") == F.col("d"))
    tail = own.select("c", (F.col("pos") - h + F.col("k")).alias("depth"), "digest", "chars")
    return head.unionByName(tail), convs.select("c", "length")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(turns_of(table(spark, sf_dir, "conversations")), "conversations")
    return trie(*rebuilt(turns))


_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""

OP12_SQL = f"""
WITH t AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), own AS (SELECT c, list({{'r': role, 't': text}} ORDER BY pos) AS l FROM t GROUP BY c
), h AS (SELECT c, l, {_CRC_SQL} % {HEADS} AS h FROM own
), r AS (
  SELECT h.c, list_concat(coalesce(list_slice(b.l, 1, h), []), list_slice(h.l, h + 1, len(h.l))) AS l FROM h LEFT JOIN own b ON b.c = h.c - h.c % {FAMILY}
), m AS (SELECT c, d, len(l) AS n, list_slice(l, 1, d) AS p, list_slice(l, 1, d - 1) AS up FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM r)
), node AS (
  SELECT p, d AS depth, min(c) AS conv_id, any_value(up) AS up, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
    coalesce(length(any_value(p)[d].t), 0) AS chars FROM m GROUP BY p, d
), kids AS (SELECT up AS p, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p, depth)
), below AS (SELECT list_slice(p, 1, a) AS p, a AS depth, (n_children = 0)::BIGINT AS leaf, (n_convs - 1) * chars AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_node)
), sums AS (SELECT p, depth, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY p, depth)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums s ON s.p = f.p AND s.depth = f.depth LEFT JOIN node q ON f.depth > 0 AND q.p = f.up AND q.depth = f.depth - 1
"""
