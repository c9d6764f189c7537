"""Decontamination against brute force over windows, with its edge cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallygrain.llm import decontamination as dc
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def words(text):
    return dc.plain(text).decode().split()


def brute(docs, items, window):
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, question in items:
            q = words(question)
            n = min(window, len(q))
            grams = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out[i] = (len(w), len(hit), sorted(found))
    return out


def table_of(rng, n, low, high):
    return [(i, rng.choice(" \n,.-").join(rng.choice(["a", "B", "c", "dé", "7"]) for _ in range(rng.randint(low, high)))) for i in range(n)]


@pytest.mark.parametrize("seed,automaton_words", [(1, 10**6), (2, 40)])
def test_brute_force(spark, seed, automaton_words, monkeypatch):
    rng = random.Random(seed)
    docs, items = table_of(rng, 60, 0, 80), [*table_of(rng, 25, 3, 14), (90, "")]
    monkeypatch.setattr(dc, "PIECE_WORDS", 5)
    found = dc.contamination(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=5, automaton_words=automaton_words)
    got = {r["row"]["id"]: (r["n_words"], r["hit"], r["items"]) for r in found.withColumn("hit", dc.n_hit()).collect()}
    assert got == brute(docs, items, 5)
    assert any(0 < hit < n for n, hit, _ in got.values())


def test_spans_are_places_in_the_original(spark):
    passage = "Wie heißt die größte Stadt, die am Fluss liegt?"
    text = "ÄÖ 😀 vor\n\t" + passage + " -- nach"
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    items = spark.createDataFrame([(5, None, passage), (6, "vor", "nicht da")], "item_id long, text string, answer string")
    row = dc.contamination(docs, items, item_texts=("text", "answer")).first()
    assert row["items"] == ["5", "6"]
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["vor\n\t" + passage[:-1]]


def test_edge_cases(spark):
    long = "tic tac " * 200_000 + "one two three four five six seven eight nine ten"
    ten = "One two three four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, " .,\n"), (4, long), (4, long), (None, "x " + ten), (5, "one two three four five six seven eight nine")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("row", "items", "runs", "spans", "n_words", "scanned", "start")])
    items = spark.createDataFrame([(7, ten), (7, ten), (None, ten), (8, None), (9, "?!"), (10, "word")], "item_id long, text string").withColumn("item", F.lit("clash"))
    got = dc.contamination(frame, items).select("row.doc_id", "n_words", dc.n_hit().alias("hit"), "items", "row.items").collect()
    assert [r["n_words"] for r in got if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert [(r["n_words"], r["hit"], r[3]) for r in got if r["doc_id"] == 4] == [(400_010, 10, ["", "7"])] * 2
    assert [(r["hit"], r[3]) for r in got if r["doc_id"] is None] == [(11, ["", "7"])]
    assert [r["hit"] for r in got if r["doc_id"] == 5] == [0]
    clean = dc.clean_documents(frame, items)
    assert clean.columns == frame.columns and sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 3, 5]
    assert dc.contamination(frame.limit(0), items).count() == 0
    assert all(not r["items"] for r in dc.contamination(frame.select("text"), items.limit(0)).collect())


def test_query_finds_something(spark):
    got = dc.op11_decontamination(spark, "/root/testdata/sf0.01").collect()
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)
    assert {r["items_sha256"] for r in got if not r["n_items"]} == {hashlib.sha256(b"").hexdigest()}
