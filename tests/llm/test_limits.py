"""Long white space in packing; language filters against exact sets of n-grams."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import language_id as li
from tallygrain.llm import packing
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def test_long_white_space_is_packed(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.public_tokenizer())
    texts = [" " * 2_000_000, " " * 9_999 + "x", "a" + "\n" * 10_000 + "b", "\u3000" * 12_000, "x" * 300_000, "7 " * 20_000]
    ids = packing.encoder(packing.public_tokenizer())
    for text in texts:
        assert ids(text) == slow.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in packing.pack(docs, packing.public_tokenizer()).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == {i: len(ids(t)) + 1 for i, t in enumerate(texts)}


def test_filters_agree_with_exact_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    train, test = docs.where(~li.held_out(F.col("doc_id"))), docs.where(li.held_out(F.col("doc_id")))
    model = li.fit(train)
    counts = {}
    for r in train.where("lang is not null and text is not null").collect():
        counts.setdefault(r["lang"], Counter()).update(li.grams([r["text"]])[0].tolist())
    share = {lang: {g: n / c.total() for g, n in c.items() if n >= li.MIN_COUNT} for lang, c in counts.items()}
    most = Counter()
    for own in share.values():
        for g, p in own.items():
            most[g] = max(most[g], p)
    known = [{g for g, p in share[lang].items() if p >= li.RATIO * most[g] and p >= li.MIN_SHARE} for lang in model.langs]
    rows = test.where("text is not null").collect()
    got, total = model.shares([r["text"] for r in rows])
    exact = np.array([[np.mean([g in own for g in li.grams([r["text"]])[0].tolist()] or [0]) for own in known] for r in rows])
    assert np.abs(got - exact)[total >= 50].max() < 0.05 and np.abs(got - exact).mean() < 0.005
    clear = np.sort(exact, axis=1)[:, -1] - np.sort(exact, axis=1)[:, -2] > 0.05
    assert (got.argmax(axis=1) == exact.argmax(axis=1))[clear].all()
