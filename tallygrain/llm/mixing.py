"""Mixing sources to target weights: budgets down a tree of domains, languages and sources, and a seeded prefix of each leaf."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import ready, require, table
from tallygrain.session import materialize

SEED = 17
MAX_EPOCHS = 2
#: Tokens asked for, as a share of those that one epoch over all documents has.
BUDGET_SHARE = 0.6
#: Rows that one task orders at once, about.
BUCKET_ROWS = 512

LEVELS = ["domain", "lang", "source"]
#: The seeded order of a leaf; rows that are equal in all of it have equal texts, and any of them stands for the others.
_ORDER = ["key", "id", "tokens", "text_hash"]
#: Leaves that are sent to all tasks.
FEW_LEAVES = 100_000


def words(text: Column) -> Column:
    """Tokens of a text for budgets: its runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budgets of siblings: in proportion to weight, none above its capacity; what is short goes to siblings with room, by weight.

    With siblings ordered by capacity per weight, the level of water is the largest of those that follow if just the siblings before
    are full.
    """
    order = Window.partitionBy(*parent).orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*parent)
    ratio = nodes.withColumn("ratio", F.col("capacity").cast("double") / F.col("weight"))
    room = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weight = F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ratio.withColumn("level", room.cast("double") / weight).withColumn("water", F.max("level").over(group))
    budget = F.when(F.col("ratio") <= F.col("water"), F.col("capacity")).otherwise(F.floor(F.col("weight") * F.col("water")))
    return level.withColumn("given", F.least(budget, F.col("capacity")).cast("long")).drop("ratio", "level", "water")


def budgets(leaves: DataFrame, weights: DataFrame, budget: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (``LEVELS``, ``docs``, ``tokens``) with the tokens ``given`` to each.

    ``weights`` has ``level`` (0 for domains), ``name`` and a whole, positive ``weight``; nodes without one weigh 1. A node never gets more than
    the capacity of its leaves, so that a shortage is met by siblings first and by the relatives of their parent after that. Fractions
    of a token are not given out.
    """
    with_capacity = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    above = leaves.sparkSession.range(1).select(F.lit(budget).cast("long").alias("given"))
    parent: list[str] = []
    for depth, name in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        nodes = with_capacity.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        own = weights.where(F.col("level") == depth).select(F.col("name").alias(name), F.col("weight").cast("long").alias("w"))
        weighed = nodes.join(own, name, "left").withColumn("weight", F.coalesce("w", F.lit(1))).drop("w")
        if parent:
            joined = weighed.join(above, parent)
        else:
            joined = weighed.withColumn("given", F.lit(budget).cast("long"))
        above = _fill(joined, parent or [F.lit(0)], name).select(*path, "given")
        parent = path
    return leaves.join(above, LEVELS)


def mix(docs: DataFrame, weights: DataFrame, domain: Column, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``id_col``, ``domain``, ``lang``, ``source``, ``tokens``, ``leaf_budget`` and ``times`` per row of ``docs``.

    A leaf's budget buys whole epochs and then the longest prefix, in seeded order, that fits into what is left. ``times`` says how often
    a document is used; 0 leaves it out. NULL domains, languages and sources are nodes with an empty name; NULL and empty texts
    have no token and go with every whole epoch and prefix; repeated rows are rows of their own. An empty table gives an empty result.

    Orders are taken in buckets of about ``bucket_rows`` documents by the leading digits of the order key, so that a leaf with a third
    of all rows is spread over the cluster; sums of buckets say where each starts.
    """
    require(docs, id_col, text_col, lang_col, source_col)
    used = _placed(docs, weights, domain, budget_share, max_epochs, seed, bucket_rows, id_col, text_col, lang_col, source_col)
    return used.select(F.col("id").alias(id_col), *LEVELS, "tokens", "leaf_budget", (F.col("epochs") + F.col("inside").cast("long")).cast("int").alias("times"))


def _leaf(domain: Column, lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(LEVELS, (domain, F.col(lang_col), F.col(source_col)))]


def _order_key(seed: int, row_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"))


def _placed(docs: DataFrame, weights: DataFrame, domain: Column, budget_share: float, max_epochs: int, seed: int, bucket_rows: int, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """Rows without their texts: ``id``, ``LEVELS``, ``tokens``, ``key`` and ``text_hash``, the leaf's budget and ``epochs``, and whether the prefix holds them (``inside``)."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), *_leaf(domain, lang_col, source_col), words(F.col(text_col)).alias("tokens"), F.xxhash64(text_col).alias("text_hash")), "sizes")
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    given = materialize(budgets(leaves, weights, int(total * budget_share), max_epochs), "budgets")
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("given") / F.col("tokens"))).otherwise(0).cast("long")
    leaf = given.withColumn("epochs", epochs).withColumn("rest", F.col("given") - F.col("epochs") * F.col("tokens")).select(*LEVELS, F.col("given").alias("leaf_budget"), "epochs", "rest", F.ceil(F.col("docs") / bucket_rows).alias("buckets"))
    lead = F.conv(F.substring(F.col("key"), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    placed = rows.join(leaf, LEVELS).withColumn("key", _order_key(seed, F.col("id"))).withColumn("bucket", F.floor(lead * F.col("buckets")))
    placed = materialize(placed, "placed")
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("n"))
    along = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sums.select(*LEVELS, "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("start")), "starts")
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.withColumn("upto", F.sum("tokens").over(inside)).join(starts, [*LEVELS, "bucket"])
    return upto.withColumn("inside", (F.col("rest") > 0) & (F.col("start") + F.col("upto") <= F.col("rest")))


#: Targets of the query: domains, then languages; sources weigh alike.
WEIGHTS = [(0, "crawl", 50), (0, "reference", 30), (0, "forum", 20), (1, "en", 60), (1, "de", 15), (1, "fr", 15), (1, "es", 10)]


def weights_of(spark: SparkSession) -> DataFrame:
    return ready(spark).sql("SELECT * FROM VALUES " + ", ".join(map(str, WEIGHTS)) + " AS w(level, name, weight)")


def domain_of(source: Column) -> Column:
    """The domain of a source, by its number."""
    return F.when(source == "src0", "crawl").when(source.isin("src1", "src2", "src3", "src4"), "reference").otherwise("forum")


def mixed_documents(docs: DataFrame, weights: DataFrame, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of ``docs`` as often as the mix uses them: rows, edge cases and orders as of ``mix``, decided row by row.

    The prefix of a leaf ends at one place of its order, so that rows are decided where they are read; only a leaf's last place is looked up. Of
    rows that are equal to it (equal ids and texts), as many are used as fit.
    """
    require(docs, "doc_id", "text", "lang", "source")
    domain = domain_of(F.col("source"))
    used = materialize(_placed(docs, weights, domain, BUDGET_SHARE, MAX_EPOCHS, seed, bucket_rows, "doc_id", "text", "lang", "source").select(*LEVELS, *_ORDER, "epochs", "inside"), "used")
    place = F.struct(*_ORDER)
    ends = used.groupBy(*LEVELS).agg(F.first("epochs").alias("epochs"), F.max(F.when(F.col("inside"), place)).alias("end"))
    ends = materialize(ends, "ends")
    at_end = used.join(ends.select(*LEVELS, "end"), LEVELS).where(place == F.col("end")).groupBy(*LEVELS).agg(F.count("*").alias("copies"), F.count_if("inside").alias("fit"))
    leaf = materialize(ends.join(at_end, LEVELS, "left").select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "epochs", "end", "copies", "fit"), "leaf_ends")
    divided = leaf.where("fit < copies").limit(1).count() > 0
    leaf = F.broadcast(leaf) if leaf.count() <= FEW_LEAVES else leaf

    # Generated columns are computed once; as expressions they would be computed anew in every condition.
    sizes = F.array(F.struct(words(F.col("text")).alias("tokens"), F.xxhash64("text").alias("text_hash")))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), *_leaf(domain, "lang", "source"), F.inline(sizes))
    known = held.join(leaf, [F.col(c) == F.col(f"_{c}") for c in LEVELS]).withColumn("key", _order_key(seed, F.col("id")))
    split = F.coalesce((place == F.col("end")) & (F.col("fit") < F.col("copies")), F.lit(False))
    more = F.coalesce(place <= F.col("end"), F.lit(False)).cast("long")
    used_up = (known.where(~split) if divided else known).select("row", (F.col("epochs") + more).alias("times"))
    if divided:
        used_up = used_up.unionByName(_shared(known.where(split)))
    repeated = used_up.where("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("time"))
    return repeated.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def _shared(rows: DataFrame) -> DataFrame:
    """``row`` and its ``times``, all copies together, of rows that are equal to the last place of their leaf's prefix."""
    ties = rows.groupBy("row", *LEVELS).agg(F.count("*").alias("n"), F.first("epochs").alias("epochs"), F.first("fit").alias("fit"))
    before = Window.partitionBy(*LEVELS).orderBy(F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, -1)  # rows that differ in other columns only
    room = F.col("fit") - F.coalesce(F.sum("n").over(before), F.lit(0))
    return ties.select("row", (F.col("n") * F.col("epochs") + F.least(F.greatest(room, F.lit(0)), "n")).alias("times"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs, weights_of(spark), domain_of(F.col("source")))


def _level_sql(depth: int) -> str:
    path, parent, name = LEVELS[: depth + 1], LEVELS[:depth], LEVELS[depth]
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    source = f"above{depth}"
    given = f"JOIN g{depth - 1} p USING ({', '.join(parent)})" if parent else "CROSS JOIN (SELECT budget AS given FROM total) p"
    return f"""
above{depth} AS (
  SELECT n.*, coalesce(w.weight, 1) AS weight, p.given, n.capacity::DOUBLE / coalesce(w.weight, 1) AS ratio
  FROM (SELECT {', '.join(path)}, CAST(sum(tokens) * {MAX_EPOCHS} AS BIGINT) AS capacity FROM leaf GROUP BY {', '.join(path)}) n
  LEFT JOIN (SELECT name, weight FROM w WHERE level = {depth}) w ON n.{name} = w.name {given}
), l{depth} AS (
  SELECT *, CAST(given - coalesce(sum(capacity) OVER ({by} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM {source}
), g{depth} AS (
  SELECT {', '.join(path)}, CAST(least(CASE WHEN ratio <= water THEN capacity ELSE floor(weight * water) END, capacity) AS BIGINT) AS given
  FROM (SELECT *, max(level) OVER ({by}) AS water FROM l{depth})
)"""


OP9_SQL = f"""
WITH w(level, name, weight) AS (VALUES {', '.join(map(str, WEIGHTS))}),
d AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN source IN ('src1', 'src2', 'src3', 'src4') THEN 'reference' ELSE 'forum' END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents
), leaf AS (SELECT domain, lang, source, count(*) AS docs, sum(tokens) AS tokens FROM d GROUP BY ALL
), total AS (SELECT CAST(floor(sum(tokens) * {BUDGET_SHARE}::DOUBLE) AS BIGINT) AS budget FROM leaf), {_level_sql(0)}, {_level_sql(1)}, {_level_sql(2)},
k AS (
  SELECT d.*, given, CASE WHEN leaf.tokens > 0 THEN CAST(floor(given / leaf.tokens) AS BIGINT) ELSE 0 END AS epochs, leaf.tokens AS all_tokens
  FROM d JOIN leaf USING (domain, lang, source) JOIN g2 USING (domain, lang, source)
), o AS (SELECT *, given - epochs * all_tokens AS rest, md5('{SEED}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM k
), s AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, tokens ROWS UNBOUNDED PRECEDING) AS upto FROM o)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(given AS BIGINT) AS leaf_budget,
  CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS INT) AS times FROM s
"""
