"""Lines below MIN_CHARS: copies of all of them, one edit from SHORT_CHARS on."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import line_dedup, queries
from tallygrain.llm.common import ready


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def test_short_copies_are_counted_and_go(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Les.\nOne line of its own here, long"), (2, "Les.\nLet."), (3, "Nt onor.\n \n-"), (4, "Nt  onor.\nLes.\n-\nstays 4")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {(r["doc_id"], r["line_no"]): (r["n_copies"], r["n_links"]) for r in queries.QUERIES["op8_line_dedup"](spark, str(tmp_path)).collect()}
    assert rows == {(1, 0): (3, 0), (1, 1): (1, 0), (2, 1): (1, 0), (3, 0): (1, 1), (3, 2): (2, 0), (4, 0): (1, 1), (4, 3): (1, 0)}
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_lines(spark, docs, "").collect()}
    assert got == {1: "Les.\nOne line of its own here, long", 2: "Let.", 3: "Nt onor.\n \n-", 4: "stays 4"}


def test_short_join_loses_no_pair(spark):
    rng = random.Random(8)
    lines = sorted({"".join(rng.choice("ab é") for _ in range(rng.randint(4, 7))).strip() or "a" for _ in range(150)} | {"x" * n for n in range(17, 23)})
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    seen = line_dedup.lines_of(docs, min_chars=1)
    names = {r["i"]: r["line"] for r in seen.select(F.concat(F.hex("h"), F.lit("-"), F.hex("g")).alias("i"), "line").collect()}

    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        return a != b and any(a[:i] == b[:i] and a[i + (len(a) == len(b)) :] == b[i + 1 :] for i in range(len(b)))

    expected = {(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :] if min(len(a), len(b)) in range(5, 20) and one_edit(a, b)}
    got = [tuple(sorted((names[r["a"]], names[r["b"]]))) for r in line_dedup.short_join(seen).collect()]
    assert sorted(got) == sorted(expected) and expected
