"""Stages of the pipeline on rows that share ids, on chains of lines, on families of texts; the line operator against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallygrain.llm import line_dedup, minhash_dedup, mixing
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def linked(a, b):
    """Whether two lines are near copies: two edits from 20 characters on, one from 5 on."""
    if a == b:
        return False
    short = min(len(a), len(b))
    return distance(a, b) <= (2 if short >= 20 else 1 if short >= 5 else 0)


def lines_in(docs):
    return [(i, k, line.strip()) for i, text in docs for k, line in enumerate((text or "").split("\n")) if line.strip()]


def made(rng, n):
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.choice([2, 6, 18, 21, 25]))).strip() or "x" for _ in range(12)]

    def edited(x):
        out = list(x)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(out) + 1)
            out[at : at + 1] = rng.choice([[], ["z"], ["y", "w"]])
        return "".join(out)

    return [(i, "\n".join(edited(rng.choice(base)) for _ in range(rng.randint(1, 5)))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_brute_force(spark, seed):
    docs = made(random.Random(seed), 60)
    places = lines_in(docs)
    first, copies = {}, Counter(x for _, _, x in places)
    for i, k, x in sorted(places):
        first.setdefault(x, (i, k))
    near = {x: {y for y in first if linked(x, y)} for x in first}
    label = {x: first[x] for x in first}
    while (new := {x: min([label[x], *(label[y] for y in near[x])]) for x in first}) != label:
        label = new
    expected = sorted((*first[x], copies[x], len(near[x]), *label[x]) for x in first)
    got = line_dedup.classes(spark.createDataFrame(docs, "doc_id long, text string"), copies_from=1)
    assert sorted(tuple(r)[2:] for r in got.collect()) == expected and any(n for n in map(len, near.values()))


@pytest.mark.parametrize("seed", [3, 4])
def test_lines_go_only_near_a_kept_one(spark, seed):
    docs = made(random.Random(seed), 60)
    seen, kept, left = set(), [], {}
    for i, k, x in sorted(lines_in(docs)):  # the earliest first: a line stays if it is neither a copy nor near one that stayed
        if x not in seen:
            seen.add(x)
            if not any(linked(x, y) for y in kept):
                kept.append(x)
                left.setdefault(i, []).append(x)
    got = line_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), copies_from=1).collect()
    assert {r["doc_id"]: [x.strip() for x in r["text"].split("\n") if x.strip()] for r in got} == left


def test_a_chain_keeps_every_third_line(spark):
    line = "abcdefghijklmnopqrstuvwxyz"
    docs = [(k, "#" * k + line[k:]) for k in range(11)]
    got = line_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 3, 6, 9]


def test_rows_with_one_id_keep_their_own_lines(spark):
    docs = [
        (1, "a line that is there twice, at least\nand a second line of the first row"), (2, "a line that is there twice, at least\nanother row of id two"), (2, "a line nobody else has in this table\nlast"),
        (None, "a line that is there twice, at least\nno id, first"), (None, "nobody has this line, which has no id\nno id, second"), (5, None), (6, ""),
    ]
    got = line_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), copies_from=1).collect()
    kept = sorted(map(str, ((r["doc_id"], r["text"]) for r in got)))
    assert kept == sorted(map(str, [
        (None, "a line that is there twice, at least\nno id, first"), (1, "and a second line of the first row"), (2, "another row of id two"), (2, docs[2][1]), (None, docs[4][1]), (5, None), (6, ""),
    ]))


def test_depleted_documents_go(spark):
    lines = [f"line {chr(97 + k) * 6} of the first text, {'word ' * 8}" for k in range(12)]
    other = [f"something else {chr(97 + k) * 6} entirely {'more ' * 7}" for k in range(12)]
    docs = [(1, "\n".join(lines)), (2, "\n".join(lines[:10] + other[:2])), (3, "\n".join(lines[:3] + other[2:12]))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 3: "\n".join(other[2:12])}


def test_mix_is_decided_row_by_row(spark):
    rng = random.Random(6)
    docs = [(rng.randrange(30), "word " * rng.randint(0, 9), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "src2", "src7"])) for _ in range(400)]
    docs += [(1, "same row of text", "en", "src0")] * 90 + [(None, f"own text {k % 7}", "en", "src0") for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("times", F.lit(1))
    weights = mixing.weights_of(spark)
    used = mixing.mix(frame, weights, mixing.domain_of(F.col("source")), bucket_rows=16).collect()
    got = mixing.mixed_documents(frame, weights, bucket_rows=16)
    assert got.columns == frame.columns

    def leaf(r):
        return r["lang"] or "", r["source"]

    want, have = Counter(), Counter()
    for r in used:
        want[leaf(r), r["doc_id"], r["tokens"]] += r["times"]
    for r in got.collect():
        have[leaf(r), r["doc_id"], len(r["text"].split())] += 1
    assert +want == have
    budget = {leaf(r): r["leaf_budget"] for r in used}
    spent = Counter()
    for (of, _, tokens), times in have.items():
        spent[of] += tokens * times
    assert all(spent[x] <= budget[x] for x in spent)


def family(rng, n, shared, words):
    """Texts of which a share is one passage; the rest is each text's own."""
    common = [f"c{k}" for k in range(int(shared * words))]
    return [" ".join(common + [f"o{rng.randrange(10**9)}" for _ in range(words - len(common))]) for _ in range(n)]


def test_families_of_half_similar_texts_make_few_pairs(spark, monkeypatch):
    texts = family(random.Random(2), 1500, 0.8, 100)  # a similarity of about 0.63
    compared = []
    verify = minhash_dedup._verified
    monkeypatch.setattr(minhash_dedup, "_verified", lambda pairs, *rest: compared.append(pairs.count()) or verify(pairs, *rest))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9000, texts[7] + " end")], "doc_id long, text string")
    got = minhash_dedup.one_of_each(docs)
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(1500))
    assert sum(compared) < 45_000  # all pairs would be 1,100,000


def test_crowded_buckets_lose_no_pair(spark):
    rng = random.Random(4)
    docs = []
    for text in family(rng, 12, 0.75, 80):
        words = text.split()
        for _ in range(8):
            copy = list(words)
            for at in rng.sample(range(len(words)), rng.randint(0, 3)):
                copy[at] = f"n{rng.randrange(10**6)}"
            docs.append((rng.randrange(10**9), " ".join(copy)))

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    frame = spark.createDataFrame([(t.encode(), t) for _, t in docs], "s binary, text string")
    for crowd in (64, 1):
        parent = {t: t for _, t in docs}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in minhash_dedup.links(frame, crowd=crowd).collect():
            parent[find(bytes(r["a"]).decode())] = find(bytes(r["b"]).decode())
        assert all((find(docs[i][1]) == find(docs[j][1])) == (root[i] == root[j]) for i in range(len(docs)) for j in range(i))
