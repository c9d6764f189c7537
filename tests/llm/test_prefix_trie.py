"""The trie against a brute-force one; the tour's ranks; edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallygrain.llm import prefix_trie as pt
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def brute(convs):
    """Node rows of ``{id: [(role, text), ...]}``."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[: len(p)] == p]
        childless = [q for q in below if not any(r[:-1] == q and r for r in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(p))))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), sum(len(q) == len(p) + 1 for q in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def frame_of(spark, convs):
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    convs = {rng.randrange(-50, 10**12): [(rng.choice("ua"), rng.choice(["", "x", "y😀"])) for _ in range(rng.randint(1, 5))] for _ in range(80)}
    convs |= {i: [("u", "one")] * 3 for i in range(40)}
    convs[7] = [("u", "one")] * 60  # one path is deep
    assert trie_rows(pt.conversation_trie(frame_of(spark, convs))) == brute(convs)


def test_rebuilt_conversations(spark):
    rng = random.Random(5)
    convs = {c: [("u", rng.choice("abc")) for _ in range(rng.randint(1, 8))] for c in [*range(100, 140), *range(205, 215), *range(300, 304), -250, -200]}

    def rebuild(c):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        return convs.get(base, [])[:h] + convs[c][h:]

    turns = pt.turns_of(frame_of(spark, convs))
    got = trie_rows(pt.trie(*pt.rebuilt(turns)))
    again = {c: rebuild(c) for c in convs}
    assert any(not x for x in again.values())
    assert got == brute(again)


@pytest.mark.parametrize("per_task", [3, 10**6])
def test_ranks_of_any_list(spark, per_task):
    rng = random.Random(9)
    order = [0, *rng.sample(range(1, 500), 499)]
    arcs = spark.createDataFrame([(a, b) for a, b in zip(order, [*order[1:], None])], "arc long, next long")
    got = {r["arc"]: r["rank"] for r in pt.ranked(arcs, 500, per_task).collect()}
    assert [got[a] for a in order] == list(range(500))


def test_many_children_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_PER_CHUNK", 7)
    convs = {c: [("u", "hot")] for c in range(0, 600, 2)} | {c: [("u", f"own {c}")] for c in range(1, 600, 2)}
    assert trie_rows(pt.conversation_trie(frame_of(spark, convs))) == brute(convs)


def test_edge_cases(spark):
    long = "z" * 300_000
    rows = [(1, None, None, None), (1, 0, "u", long), (1, 0, "u", long), (2, None, "", ""), (None, 1, "u", "lost"), (3, 5, "", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *[F.lit(1).alias(c) for c in ("c", "pos", "depth", "node", "digest", "_part")])
    convs = {1: [("", ""), ("u", long), ("u", long)], 2: [("", "")], 3: [("", "")]}
    assert trie_rows(pt.conversation_trie(frame)) == brute(convs)
    assert pt.conversation_trie(frame.limit(0)).count() == 0
