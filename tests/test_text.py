"""Extraction and terms on literal markup."""

import pytest
from pyspark.sql import functions as F

from tallygrain.operators import text as tx

REVIEW = """<html><span class="summary">Good &amp; fair</span><span class="summary">Bad</span><span class="summary">So <b>so</b></span>
<time class="date subtle small" datetime="2018-01-02">x</time><time class="date subtle small" datetime="2018-01-03">y</time>
<span class="value-title" title="4.0"></span><span class="value-title" title="2.0"></span><span class="value-title" title="3.0"></span>
<div class="subRatings module"><ul><li><div class="minor">Culture &amp; Values</div><span class="gdBars gdRatings med " title="3.0"></span></li>
<li><div class="minor">Work/Life Balance</div><span class="gdBars gdRatings med " title="5.0"></span></li>
<li><div class="minor">Senior Management</div><span class="gdBars gdRatings med " title="1.0"></span></li></ul></div>
<p class=" pros mainText truncateThis wrapToggleStr">free lunch</p><p class=" cons mainText truncateThis wrapToggleStr">long
hours</p></html>"""


def test_review_rows_align_and_pad(spark):
    pages = spark.createDataFrame([(1, REVIEW), (2, "<html></html>")], "page_id int, html string")
    table = tx.review_rows(pages).orderBy("pos").collect()
    assert len(table) == 3 and {r.page_id for r in table} == {1}
    assert [r.Summary for r in table] == ["Good & fair", "Bad", "So so"]
    assert [r.Date for r in table] == ["2018-01-02", "2018-01-03", None]
    assert [r.OverallRating for r in table] == ["4.0", "2.0", "3.0"]
    first = table[0]
    assert (first.WorkLifeBalance, first.CultureValues, first.CareerOpportunities, first.CompBenefits, first.SeniorManagement) == ("5.0", "3.0", None, None, "1.0")
    assert first.Pros == "free lunch" and first.Cons == "long\nhours" and table[1].Pros is None


def test_nodes_in_page_order(spark):
    pages = spark.createDataFrame([(1, '<p>a</p><p x="1">b &lt; c</p><a href="u">t</a><pre>no</pre>')], "page_id int, html string")
    nodes = tx.extract_nodes(pages, "page_id", "html", {"p": tx.node_pattern("p"), "link": tx.attribute_pattern("a", "href"), "time": tx.node_pattern("time")})
    assert sorted((r.node, r.pos, r.text) for r in nodes.collect()) == [("link", 0, "u"), ("p", 0, "a"), ("p", 1, "b < c")]


def test_tokens(spark):
    df = spark.createDataFrame([("The Été is GREAT, a b2b x",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.tokens(F.col("t"))).collect()] == [["été", "great", "b2b"], []]


def test_document_frequency_bounds(spark):
    docs = [(1, "common rare1 pair"), (2, "common pair pair"), (3, "common other"), (4, "common"), (5, None)]
    df = spark.createDataFrame(docs, "id int, t string")
    got = sorted((r.id, r.term, r.tf, r.df) for r in tx.doc_term(df, "id", "t", stop=["zzz"], max_df=0.7).collect())
    assert got == [(1, "pair", 1, 2), (2, "pair", 2, 2)]
    kept = {r.term for r in tx.doc_term(df, "id", "t", stop=["zzz"], max_df=0.8).collect()}
    assert kept == {"pair", "common"}


def test_word_frequency(spark):
    df = spark.createDataFrame([("good good pay", "hours"), (None, "hours long")], "pros string, cons string")
    got = sorted((r.side, r.term, r.n) for r in tx.word_frequency(df, ["pros", "cons"], 1).collect())
    assert got == [("cons", "hours", 2), ("pros", "good", 2)]


def test_topics(spark):
    docs = [(i, "apple pear fruit juice" if i % 2 else "engine wheel motor road") for i in range(40)]
    df = spark.createDataFrame(docs, "id int, t string")
    vocabulary, model, features = tx.topic_model(df, "id", "t", k=2)
    sums = tx.topic_weights(model, features, "id").groupBy("id").agg(F.sum("weight").alias("w")).collect()
    assert len(sums) == 40 and all(r.w == pytest.approx(1) for r in sums)
    topics = {r.id: r.topic for r in tx.assign_topic(model, features, "id").collect()}
    assert len({topics[i] for i in range(0, 40, 2)}) == 1 and len({topics[i] for i in range(1, 40, 2)}) == 1
    words = tx.topic_words(model, vocabulary, 4).collect()
    assert len(words) == 8 and {r["rank"] for r in words} == {1, 2, 3, 4}


def test_a_topic_step_is_expectation_maximization(spark):
    """Two iterations against the same computation in numpy, and a document without a kept term."""
    import numpy as np

    docs = [(i, " ".join(["apple", "pear", "plum", "wheel", "road", "motor"][(i * 5 + j) % 6] for j in range(4))) for i in range(12)] + [(99, "unique")]
    df = spark.createDataFrame(docs, "id int, t string")
    counts = tx.doc_term(df, "id", "t", stop=[])
    starts = {}
    for iterations in (0, 2):
        vocabulary, model, documents = tx.topic_model(df, "id", "t", k=3, max_iter=iterations)
        d = {r[0]: np.array(r[1:]) for r in model.documents.collect()}
        w = {r[0]: np.array(r[1:]) for r in model.terms.collect()}
        starts[iterations] = d, w
    pairs = [(r.id, r.term, r.tf) for r in counts.collect()]
    d, w = starts[0]
    for _ in range(2):
        totals = sum(w.values())
        p = {(i, t): (w[t] + 0.1) * (d[i] + 0.1) / (totals + 0.1 * len(w)) for i, t, _ in pairs}
        g = {(i, t): tf * p[i, t] / p[i, t].sum() for i, t, tf in pairs}
        d, w = ({x: sum(v for k, v in g.items() if k[at] == x) for x in old} for at, old in ((0, d), (1, w)))
    assert all(starts[2][0][i] == pytest.approx(d[i], abs=1e-9) for i in d) and all(starts[2][1][t] == pytest.approx(w[t], abs=1e-9) for t in w)
    alone = [r.weight for r in tx.topic_weights(model, documents, "id").where("id = 99").collect()]
    assert alone == pytest.approx([1 / 3] * 3)
    words = tx.topic_words(model, vocabulary, 2).collect()
    assert {r.term for r in words} <= set(w) and all(0 < r.weight < 1 for r in words)


def test_stop_words_hold_the_list_of_spark(spark):
    """Every word of Spark's own list goes, contractions too."""
    from pyspark.ml.feature import StopWordsRemover

    words = StopWordsRemover.loadDefaultStopWords("english")
    df = spark.createDataFrame([(" ".join(words) + " lunch isn't bad; they'll say so",)], "t string")
    assert df.select(tx.tokens(F.col("t"))).first()[0] == ["lunch", "bad", "say"]


def test_topics_in_any_blocks(spark, monkeypatch):
    """Pairs are written once, whatever the iterations; sums do not depend on the blocks; repeated ids are one document, those without an id only start the fit."""
    from pathlib import Path

    words = ["apple", "pear", "plum", "wheel", "road", "motor", "cloud"]
    docs = [(i % 30, " ".join(words[(i * 5 + j * j) % 7] for j in range(4))) for i in range(40)] + [(None, "apple road"), (None, "cloud"), (98, None), (99, "unique")]
    df = spark.createDataFrame(docs, "id int, t string")
    materialize, kept = tx.materialize, []

    def recorded(frame, label):
        out = materialize(frame, label)
        kept[-1].add(Path(out.inputFiles()[0].removeprefix("file:")).parent)
        return out

    monkeypatch.setattr(tx, "materialize", recorded)

    def fit(iterations, **blocks):
        for name, value in blocks.items():
            monkeypatch.setattr(tx, name, value, raising=False)
        kept.append(set())
        vocabulary, model, _ = tx.topic_model(df, "id", "t", k=7, max_iter=iterations)
        d, w = ({r[0]: r[1:] for r in x.collect()} for x in (model.documents, model.terms))
        return d, w, model.totals, {r["term"]: r["df"] for r in vocabulary.collect()}

    whole = fit(3)
    parts = fit(3, BLOCK_CHARS=90, CELL_PAIRS=9, CHUNK=4)
    for x, y in zip(whole[:2], parts[:2]):
        assert x.keys() == y.keys() and None not in x and all(x[n] == pytest.approx(y[n]) for n in x)
    assert whole[2] == pytest.approx(parts[2]) and whole[3] == parts[3] and len(whole[0]) == 30
    assert None in fit(0)[0] and len(fit(1)[1]) == len(whole[3])
    left = [sum(x.exists() for x in tables) for tables in kept]
    assert left[0] == left[1] == left[3] and len(kept[0]) > left[0]  # three iterations leave as much as one
