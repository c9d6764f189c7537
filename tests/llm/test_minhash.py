"""The pipeline's near duplicates against the definition: five-word shingles, Jaccard similarity of 0.8 or more."""

import random

import corpus_pipeline
import pytest

from tallygrain.llm import minhash_dedup, simhash_dedup
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def kept_by_definition(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(min(docs[i][0] for i in range(len(docs)) if root[i] == r) for r in set(root))


def test_stage_removes_every_pair_of_the_similarity(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(12):
        words = [rng.choice("abcdefghijklmnop") + str(rng.randrange(400)) for _ in range(rng.randint(60, 300))]
        for _ in range(9):  # changed words spread over a text: similarities on both sides of the limit
            copy = list(words)
            for at in rng.sample(range(len(words)), rng.randint(0, len(words) // 20)):
                copy[at] = f"new{rng.randrange(10**6)}"
            docs.append((rng.randrange(10**9), " ".join(copy)))
    expected = kept_by_definition(docs)
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in got.collect()) == expected and 12 <= len(expected) < len(docs)


def test_rows_of_one_id_are_judged_by_their_text(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (2, "another text of its own"), (None, text), (3, None)], "doc_id long, text string")
    got = sorted(map(str, minhash_dedup.one_of_each(docs).collect()))
    assert len(got) == 4 and not any("end" in x for x in got)


def test_crowded_buckets_lose_no_link(spark):
    """Copies that are near what they were made from, and seldom near each other; the original is there for one family only."""
    rng = random.Random(5)
    docs = []
    for family in range(2):
        words = [f"{family}w{i}" for i in range(200)]
        docs += [(10**6, " ".join(words))] * (family == 0)
        for number in range(20):
            copy = list(words)
            for at in rng.sample(range(200), rng.randint(1, 6)):
                copy[at] = f"new{rng.randrange(10**6)}"
            docs.append((100 * family + number, " ".join(copy)))
    texts = spark.createDataFrame([(bytearray(t.encode()), t) for _, t in docs], "s binary, text string")
    root = {t: i for i, (_, t) in enumerate(docs)}
    for row in minhash_dedup.links(texts, crowd=3).collect():
        a, b = (root[bytes(x).decode()] for x in (row["a"], row["b"]))
        root = {t: min(a, b) if r in (a, b) else r for t, r in root.items()}
    firsts = {}
    for i, t in docs:
        firsts[root[t]] = min(i, firsts.get(root[t], i))
    assert sorted(firsts.values()) == kept_by_definition(docs)


def test_fingerprints_link_and_shingles_decide(spark, monkeypatch):
    """Without any band: what ball hashing links goes if it has the similarity, and stays if only its fingerprint is near."""
    monkeypatch.setattr(minhash_dedup, "bands", lambda values: [])
    rng = random.Random(7)
    docs, near = [], []
    for family in range(6):
        words = [f"{family}w{i}" for i in range(400)]
        first = simhash_dedup.fingerprint(" ".join(words))
        docs.append((family, " ".join(words)))
        for number in range(20):
            copy = list(words)
            copy[rng.randrange(400)] = f"new{number}"
            if 0 < (simhash_dedup.fingerprint(" ".join(copy)) ^ first).bit_count() <= 3:
                near.append((100 + 20 * family + number, " ".join(copy)))
    same = [(1000 + k, "the same three " * 200 + " ".join(f"{k}own{i}" for i in range(40))) for k in range(2)]
    assert len(near) > 20 and len({simhash_dedup.fingerprint(t) for _, t in same}) == 1
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs + near + same, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in got.collect()) == kept_by_definition(docs + near + same) == [0, 1, 2, 3, 4, 5, 1000, 1001]
