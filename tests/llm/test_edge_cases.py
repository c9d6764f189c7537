"""Every operator and stage: NULLs, empty and very long texts, repeated rows, empty tables, clashing names of extra columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import kmeans_tree, language_id, line_dedup, mixing, packing, quality_rules, simhash_dedup, url_filter, warc, wrapper_induction
from tallygrain.llm.common import ready

@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


LONG = "lorem ipsum dolor sit amet " * 8000
PROSE = " ".join(f"word{i} of prose" for i in range(60))
DOCS = [
    (1, PROSE, "en", "src0", 10), (2, None, "en", "src0", None), (3, "", None, None, 0), (None, PROSE + " more", "en", "src1", 3), (5, LONG, "de", "src2", 9),
    (6, " \n\t\n ", "fr", "src0", 5), (7, PROSE, "en", "src3", 10), (7, PROSE, "en", "src3", 10), (None, None, None, None, None),
]
CLASH = ["fp", "row", "h", "g", "key", "host", "lines", "bucket", "given", "tokens", "piece", "length", "gone", "used", "component_id", "k", "c", "l", "place", "label"]


@pytest.fixture()
def docs(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)])


def weights(spark):
    return mixing.weights_of(spark)


def test_quality(spark, docs):
    got = quality_rules.judge(docs).select("row.doc_id", "n_words", "kept", "n_repeat_words", "row.host", "row.h").collect()
    assert len(got) == len(DOCS) and {r["host"] for r in got} == {"x5"}
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    assert by[2, 0]["kept"] is False and by[3, 0]["kept"] is False and by[6, 0]["kept"] is False
    assert by[1, 180]["kept"] is True and by[None, 181]["kept"] is True and by[5, 40000]["n_repeat_words"] == 40000
    assert quality_rules.clean_documents(docs).columns == docs.columns
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_near_duplicates(spark, docs):
    got = [tuple(r) for r in simhash_dedup.near_duplicates(docs).select("doc_id", "component_id").collect()]
    assert len(got) == len(DOCS)
    assert sorted(x for x in got if x[0] in (2, 3, 6)) == [(2, 2), (3, 2), (6, 2)]  # fingerprint 0
    assert got.count((7, 1)) == 2 and (1, 1) in got
    stage = simhash_dedup.one_of_each(docs)
    assert stage.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in stage.collect()) == ["1", "2", "3", "5", "6", "None", "None"]
    assert simhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_line_dedup(spark, docs):
    got = line_dedup.classes(docs).collect()
    assert sorted((r["doc"], r["n_copies"]) for r in got if r["doc"] is not None) == [(1, 3), (5, 1)]
    stage = line_dedup.without_repeats(docs)
    assert stage.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in stage.collect()) == ["1", "2", "3", "5", "6", "None", "None"]  # both copies of 7 are gone
    assert line_dedup.classes(docs.limit(0)).count() == 0 and line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_mixing(spark, docs):
    got = mixing.mix(docs, weights(spark), mixing.domain_of(F.col("source"))).collect()
    assert len(got) == len(DOCS) and all(0 <= r["times"] <= mixing.MAX_EPOCHS for r in got)
    assert {r["tokens"] for r in got} == {180, 181, 40000, 0}
    stage = mixing.mixed_documents(docs, weights(spark))
    assert stage.columns == docs.columns and stage.count() >= 0
    assert mixing.mix(docs.limit(0), weights(spark), F.lit("x")).count() == 0


def test_packing(spark, docs):
    got = packing.pack(docs, packing.public_tokenizer()).collect()
    assert sum(r["piece"] == 0 for r in got) == len(DOCS)
    assert sorted(r["length"] for r in got if r["doc_id"] in (2, 3)) == [1, 1]
    assert packing.pack(docs.limit(0), packing.public_tokenizer()).count() == 0


def test_language(spark, docs):
    got = language_id.identify(docs.withColumn("score", F.lit("x"))).collect()
    assert len(got) == len(DOCS)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 6)} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


PAGES = [
    (1, "http://A.example.net/en/x?q#f", "<p>one</p>"), (2, None, None), (3, "no scheme", ""), (None, "http://b.org/fr/1", "<p>one</p>"),
    (5, "http://c.com", "<article>" + "long text " * 30000), (6, "x://http://y/", "<p>one</p>"), (6, "x://http://y/", "<p>one</p>"), (None, None, None),
]


@pytest.fixture()
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(["host", "path", "row", "key", "keys", "hits", "best", "digest", "bytes", "name", "reference", "template", "text", "d", "top"])])


def test_url_filter(spark, pages):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), (None, "/", "block"), ("org", "/fr/", "allow"), ("org", "/fr/", "block"), ("b.org", None, "x")], "host string, path string, action string")
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).select("row.page_id", "host", "path", "rule", "verdict").collect()}
    assert got[1, "a.example.net", "/en/x"] == ("example.net/en/", "allow")
    assert got[2, "", ""] == (None, "allow") == got[3, "", ""] == got[None, "", ""]
    assert got[None, "b.org", "/fr/1"] == ("org/fr/", "block") and got[5, "c.com", ""] == (None, "allow") and got[6, "http:", "//y/"] == (None, "allow")
    assert url_filter.judge(pages, rules).count() == len(PAGES)
    assert url_filter.judge(pages.limit(0), rules).count() == 0 and url_filter.judge(pages, rules.limit(0)).where("rule is not null").count() == 0


def test_warc(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "a"))
    got = warc.read_archives(spark, str(tmp_path / "a")).withColumn("page_id", warc.page_of(F.col("record_id"))).withColumn("to", warc.page_of(F.col("refers_to"))).collect()
    assert len(got) == len(PAGES) and all(r["problem"] is None for r in got)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append((r["record_type"], r["to"], bytes(r["payload"]).decode()))
    assert by[1] == [("revisit", 6, "<p>one</p>")] and by[6] == [("response", None, "<p>one</p>")] * 2
    assert by[2] == [("revisit", 3, "")] and by[3] == [("response", None, "")] and by[5] == [("response", None, PAGES[4][2])]
    assert sorted(by[None]) == [("revisit", 3, ""), ("revisit", 6, "<p>one</p>")]
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_main_text(spark, pages):
    got = sorted(((r["page_id"], r["text"][:9], r["n_chars"]) for r in wrapper_induction.extract(pages).collect()), key=str)
    assert got == sorted([(1, "one", 3), (2, "", 0), (3, "", 0), (None, "one", 3), (5, "long text", 299999), (6, "one", 3), (6, "one", 3), (None, "", 0)], key=str)
    assert wrapper_induction.extract(pages.limit(0)).count() == 0


def test_neighbours(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0]), (9, []), (11, [float("inf"), 0.0]), (100, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", *[F.lit("x").alias(c) for c in ("v", "id", "leaf", "ids")])
    got = sorted(tuple(r) for r in kmeans_tree.nearest(frame).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 50, 1.0), (0, 3, 3, 0.0), (50, 1, 0, 1.0), (50, 2, 2, 1.0), (50, 3, 3, 0.0)]
    assert kmeans_tree.nearest(frame.limit(0)).count() == 0


def test_pipeline_on_edges(spark, docs):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = frame.columns
        frame = stage(spark, frame, "")
        assert frame.columns == columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, frame, "")
    assert last.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0
