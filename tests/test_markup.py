"""The page reader on literal markup."""

import pytest

from tallygrain.operators import markup as mk
from tallygrain.operators.markup import Node
from tallygrain.plans.q_text import NODES
from test_text import REVIEW


def texts(page, *nodes, blocks=()):
    return [[t for _, t in own] for own in mk.read(page, nodes, blocks)[0]]


@pytest.mark.parametrize("page, node, expected", [
    ("<div>a<div>b<div>c</div></div>d</div><div>e</div>", Node("div"), ["abcd", "bc", "c", "e"]),
    ("<p>one<p>two<div>no</div>three</p>", Node("p"), ["one", "two"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul><li>e", Node("li"), ["a", "bcd", "c", "e"]),
    ("<table><tr><td>1<td>2<tr><td>3</table><p>4", Node("td"), ["1", "2", "3"]),
    ("<p>caf&eacute; &NotEqualTilde; &#x1F600; &hellip;&nbsp;&amp;lt; &copy &bogus;</p>", Node("p"), ["caf\u00e9 \u2242\u0338 \U0001f600 \u2026\xa0&lt; \u00a9 &bogus;"]),
    ("<P CLASS='x y'>a</P><p class=x>b</p><p class=\"x y\">c", Node("p", "x y"), ["a", "c"]),
    ("<p>a<!-- <p>no</p> --><script>if (a<b) '<p>no</p>'</script><style><p></style>b</p>", Node("p"), ["ab"]),
    ("<title>A &lt;p&gt; <b>t</title><p>x", Node("title"), ["A <p> <b>t"]),
    ("<a href='u?a=1&amp;b'>x</a><a>y</a><a HREF=v>z", Node("a", attribute="href"), ["u?a=1&b", "v"]),
    ("</p><b>x</i></b><p>y<br/>z<img src=q>", Node("p"), ["yz"]),
    ("<p>a < b and <3 c</p", Node("p"), ["a < b and <3 c</p"]),
    ("<div><span>in</div><span>out", Node("span"), ["in", "out"]),
    ("", Node("p"), []), (None, Node("p"), []),
])
def test_texts(page, node, expected):
    assert texts(page, node) == [expected]


def test_long_and_deep_pages():
    assert texts("<p>" + "x " * 500_000, Node("p")) == [["x " * 499_999 + "x"]]
    deep = mk.read("<div>" * 5_000 + "t", [Node("div")])[0][0]
    assert len(deep) == 5_000 and {t for _, t in deep} == {"t"}


def test_every_node_of_the_queries_has_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    counts = {r["node"]: r["count"] for r in mk.nodes_of(pages, "page_id", "html", NODES).groupBy("node").count().collect()}
    assert counts["title"] == counts["h1"] == pages.count() and counts["p"] >= pages.count() and counts["link"] > 0
    assert set(NODES) - set(counts) == {"time"}  # no test page has one


def test_reviews_align_and_pad(spark):
    pages = spark.createDataFrame([(1, REVIEW), (2, "<html></html>"), (3, None)], "page_id int, html string")
    table = mk.review_rows(pages).orderBy("pos").collect()
    assert [(r.page_id, r.Summary, r.Date, r.OverallRating, r.Pros, r.Cons) for r in table] == [
        (1, "Good & fair", "2018-01-02", "4.0", "free lunch", "long\nhours"), (1, "Bad", "2018-01-03", "2.0", None, None), (1, "So so", None, "3.0", None, None)]
    first = table[0]
    assert (first.WorkLifeBalance, first.CultureValues, first.CareerOpportunities, first.CompBenefits, first.SeniorManagement) == ("5.0", "3.0", None, None, "1.0")
    rated = mk.ratings_of(pages, "page_id", "html", mk.REVIEW_BLOCK, mk.REVIEW_LABEL, mk.REVIEW_VALUE, mk.REVIEW_CATEGORIES).collect()
    assert sorted((r.page_id, r.CultureValues) for r in rated) == [(1, "3.0"), (2, None), (3, None)]
