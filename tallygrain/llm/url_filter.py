"""URL rules by a cascade of Bloom filters, which is exact over the keys of the corpus and needs no join."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import host_of, path_of, ready, require, table
from tallygrain.session import materialize

HASHES = 7
BITS_PER_KEY = 10
#: Words of 64 bits that one cascade may put into the plan; more listed keys are spread over several passes.
MAX_WORDS = 1 << 18
MAX_LEVELS = 64


@dataclass
class Level:
    """One Bloom filter: ``words`` as comma-separated 64-bit numbers, ``seed`` apart from all other levels."""

    words: list[int]
    seed: int

    def test(self, key: Column) -> Column:
        places = [F.pmod(F.xxhash64(F.lit(self.seed + i), key), F.lit(64 * len(self.words))) for i in range(HASHES)]

        def all_set(bits: Column) -> Column:
            hits = [F.element_at(bits, F.shiftright(p, 6).cast("int") + 1).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(F.lit(63)).cast("int"))) != 0 for p in places]
            out = hits[0]
            for h in hits[1:]:
                out = out & h
            return out

        # The words become a variable: as a column they would be in the plan, in each of its texts on the driver and in its tasks, once a probe.
        return F.exists(F.array(F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")), all_set)  # folded to one literal


@dataclass
class Cascade:
    """Levels 1, 3, 5 ... encode listed keys, 2, 4, 6 ... the unlisted keys that the level before lets through."""

    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for n, level in reversed(list(enumerate(self.levels))):
            out = F.when(~level.test(key), F.lit(n % 2 == 1)).otherwise(out)
        return out


def encode(keys: DataFrame, n: int, seed: int, bits_per_key: int = BITS_PER_KEY) -> Level:
    """Bloom filter of the ``n`` rows of ``keys`` (``key``): bits are set per word before the shuffle, and only words reach the driver."""
    size = max(1, -(-n * bits_per_key // 64))
    if size > MAX_WORDS:
        raise ValueError(f"{n} keys need {size} words, more than {MAX_WORDS}")
    spots = keys.select(F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(seed + i), F.col("key")), F.lit(64 * size)) for i in range(HASHES)])).alias("p"))
    words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    bits = [0] * size
    for row in words.collect():
        bits[row["w"]] = row["b"]
    return Level(bits, seed)


def build(universe: DataFrame, bits_per_key: int = BITS_PER_KEY) -> Cascade:
    """Cascade over ``universe`` (``key``, ``listed``), whose keys are distinct.

    The words of a level are bounded by ``MAX_WORDS``. Every level is smaller than the one two before by the rate of false positives.
    """
    cascade, alive = Cascade(), {True: universe.where("listed"), False: universe.where("not listed")}
    side = True
    while n := alive[side].count():
        if len(cascade.levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: are the keys distinct?")
        level = encode(alive[side], n, 1000 * (len(cascade.levels) + 1), bits_per_key)
        cascade.levels.append(level)
        side = not side
        alive[side] = alive[side].where(level.test(F.col("key")))
    return cascade


def _keys(host: Column, path: Column, depths: list[int], lengths: list[int]) -> Column:
    """Every domain suffix of the host with a depth that rules have, joined to every path prefix with a length that rules have."""
    labels = F.size(F.split(host, r"\."))
    suffixes = F.transform(F.filter(F.lit(depths).cast("array<int>"), lambda d: d <= labels), lambda d: F.call_function("substring_index", host, F.lit("."), -d))
    prefixes = F.transform(F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def _member(lists: Cascade, part: int, passes: int) -> Callable[[Column], Column]:
    """Whether a key is listed, as far as the pass can tell."""
    if passes == 1:
        return lambda key: lists.contains(key)
    return lambda key: (F.pmod(F.xxhash64(F.lit(7), key), F.lit(passes)) == part) & lists.contains(key)


def _hit(blocks: Cascade) -> Callable[[Column], Column]:
    return lambda key: F.struct(F.length(key).alias("n"), F.length(F.substring_index(key, "/", 1)).alias("h"), key.alias("key"), blocks.contains(key).alias("blocks"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url", max_words: int = MAX_WORDS) -> DataFrame:
    """All columns of ``pages`` in the struct ``row``, with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``action`` (``block`` or ``allow``). A rule fits its host and all subdomains if the path starts
    with the rule's; the longest rule wins (of equal ones, that with the longer host); URLs without a rule get ``default``. NULL
    URLs and URLs without ``://`` have an empty host and path. Rules with a NULL host or action take no part, a NULL path counts as
    empty, and a rule listed as both blocks. Repeated rows are judged alike; empty tables are allowed on both sides.

    The universe are the candidate keys of all URLs. One cascade holds the listed keys, another those that block; URLs probe them in the
    scan. Lists that exceed ``max_words`` are divided by a hash of the key into passes, each with filters of that size.
    """
    require(pages, url_col)
    require(rules, "host", "path", "action")
    listed = rules.where("host is not null and action in ('block', 'allow')").select(F.col("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("action") == "block").alias("blocks"))
    shape = listed.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("d"), F.collect_set(F.length("path")).alias("n"), F.count("*").alias("rules")).first()
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = rows.withColumn("keys", _keys(F.col("host"), F.col("path"), sorted(shape["d"]), sorted(shape["n"])))
    corpus = keyed.select(F.explode("keys").alias("key"), F.lit(False).alias("listed"), F.lit(False).alias("blocks"))
    known = listed.select(F.concat("host", "path").alias("key"), F.lit(True).alias("listed"), "blocks")
    universe = materialize(corpus.unionByName(known).groupBy("key").agg(F.max("listed").alias("listed"), F.max("blocks").alias("blocks")), "universe")
    passes = max(1, -(-universe.count() * BITS_PER_KEY // (64 * max_words)))
    found = keyed.withColumn("hits", F.expr("cast(array() as array<struct<n:int,h:int,key:string,blocks:boolean>>)"))
    for part in range(passes):
        mine = F.pmod(F.xxhash64(F.lit(7), F.col("key")), F.lit(passes)) == part
        here = universe.where(mine) if passes > 1 else universe
        lists, blocks = build(here.select("key", "listed")), build(here.select("key", F.col("blocks").alias("listed")))

        hits = F.transform(F.filter("keys", _member(lists, part, passes)), _hit(blocks))
        found = found.withColumn("hits", F.concat("hits", hits))
        if passes > 1:
            found = materialize(found, "hits")
    return found.withColumn("best", F.array_max("hits")).select("row", "host", "path", F.col("best.key").alias("rule"), F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks"), "block").otherwise("allow").alias("verdict"))


#: Rules of the query, as given.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ready(spark).sql("SELECT * FROM VALUES " + ", ".join(map(str, RULES)) + " AS r(host, path, action)")
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(rule, rhost, rpath, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), m AS (
  SELECT page_id, host, path, (SELECT max_by(rule, length(rule)) FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule FROM p
)
SELECT page_id, host, path, m.rule, coalesce(r.verdict, 'allow') AS verdict FROM m LEFT JOIN r ON m.rule = r.rule
"""
