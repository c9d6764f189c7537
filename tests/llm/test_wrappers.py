"""Wrapper induction: matching against brute force, layouts, runs of siblings, class words, long pages."""

import functools
import random

import pytest

from tallygrain.llm import wrapper_induction as w

PAGES = "page_id long, url string, html string"


def words(i, n=30):
    return " ".join(f"w{i}x{j}" for j in range(n))


def texts(spark, pages):
    rows = spark.createDataFrame([(i, f"http://h.org/{i}", p) for i, p in enumerate(pages)], PAGES)
    return {r["page_id"]: r["text"] for r in w.extract(rows).collect()}


def random_tree(rng, n):
    lines, depth = ["0 "], 0
    for _ in range(n):
        depth = rng.randint(1, depth + 1)
        lines.append(f"{depth} {rng.choice('abc')}")
    return "\n".join(lines)


def most_pairs(a, b):
    """Simple tree matching as its definition says."""
    (labels, children), (others, grandchildren) = w._tree(a), w._tree(b)

    @functools.cache
    def match(x, y):
        @functools.cache
        def best(i, j):
            if i == len(children[x]) or j == len(grandchildren[y]):
                return 0
            p, q = children[x][i], grandchildren[y][j]
            both = match(p, q) + best(i + 1, j + 1) if labels[p] == others[q] else 0
            return max(both, best(i + 1, j), best(i, j + 1))

        return 1 + best(0, 0)

    return match(0, 0)


def test_matching_agrees_with_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        a, b = random_tree(rng, rng.randint(0, 12)), random_tree(rng, rng.randint(0, 12))
        partner = w.align(a, b)
        assert sum(p >= 0 for p in partner) == most_pairs(a, b)
        labels, others = w._tree(a)[0], w._tree(b)[0]
        used = [p for p in partner if p >= 0]
        assert used == sorted(set(used)) and all(labels[x] == others[p] for x, p in enumerate(partner) if p >= 0)


@pytest.mark.parametrize("cells", [1, 6, w.TABLE_CELLS])
def test_matching_does_not_depend_on_the_cells_in_memory(monkeypatch, cells):
    rng = random.Random(8)
    pairs = [(random_tree(rng, rng.randint(0, 14)), random_tree(rng, rng.randint(0, 14))) for _ in range(200)]
    expected = [w.align(a, b) for a, b in pairs]
    monkeypatch.setattr(w, "TABLE_CELLS", cells)
    w.align.cache_clear()
    got = [w.align(a, b) for a, b in pairs]
    w.align.cache_clear()
    assert got == expected and [sum(p >= 0 for p in x) for x in got] == [most_pairs(a, b) for a, b in pairs]


def test_long_runs_that_differ_match_exactly():
    rng = random.Random(9)
    a, b = ([rng.choice("abc") for _ in range(900)] for _ in range(2))  # over 250,000 cells
    most = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(most[j + 1], new[j], most[j] + (x == y)))
        most = new
    partner = w.align("\n".join(["0 ", *(f"1 {x}" for x in a)]), "\n".join(["0 ", *(f"1 {y}" for y in b)]))
    assert sum(p >= 0 for p in partner) == 1 + most[-1]


def test_long_pages_match_in_linear_memory():
    body = [f"1 {'h2' if i % 2 else 'p'}" for i in range(40_000)]
    own, longer = "\n".join(["0 ", *body]), "\n".join(["0 ", "1 q", *body[:20_000], "1 z", *body[20_000:], "1 r"])
    assert sum(p >= 0 for p in w.align(own, longer)) == 40_001
    page = w.read_page("<article>" + "<h2>a</h2><p>b</p>" * 20_000 + "</article>")
    assert w.main_text(page, w.skeleton(w.read_page("<article><h2>a</h2></article>")), frozenset([1])) == " ".join(["a b"] * 20_000)


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<div class='content has-sidebar'>the story</div>", "the story"),
        ("<div id='page' class='no-comments'><p>the story</div>", "the story"),
        ("<article class='post comments-open'>the story</article>", "the story"),
        ("<div class='related-work'>the story</div>", "the story"),
        ("<form id=aspnet><div>the story</div></form>", "the story"),
        ("<article>it<div class='site-footer'>much longer than the story</div></article>", "it much longer than the story"),
        ("<article>it</article><div class='site-footer'>much longer than the story</div>", "it"),
        ("<div>the story</div><div id=comments>" + "a comment " * 50 + "</div>", "the story"),
        ("<div>a story of some words</div><div class='ad-1'>buy this</div>", "a story of some words"),
        ("<article>x <math>a+1</math><xmp><b>&amp;</b></xmp></article>", "x a+1 <b>&amp;</b>"),
        ("<article>teaser</article><div>" + "story " * 50 + "</div>", ("teaser " + "story " * 50).strip()),
    ],
)
def test_class_words_leave_the_story(source, expected):
    assert w.main_text(w.read_page(source), None, frozenset()) == expected


def test_constant_blocks_go_from_runs_of_siblings(spark):
    pages = [f"<div>Menu of this host</div><div><p>{words(i)}<p>Subscribe to us today<p>{words(-i)}</div><div>Imprint</div>" for i in range(20)]
    assert texts(spark, pages) == {i: f"{words(i)} {words(-i)}" for i in range(20)}


def test_every_layout_of_a_host_has_a_template(spark):
    pages = [f"<div>Menu</div><section><p>{words(i)}</section>" for i in range(30)]
    pages += [f"<table><tr><td>Other menu</table><ul><li>{words(i)}</ul><blockquote>Other imprint</blockquote>" for i in range(30, 40)]
    assert texts(spark, pages) == {i: words(i) for i in range(40)}


def test_copies_are_one_story(spark):
    same = "".join(f"<p>{words(j)}" for j in range(3))
    pages = [f"<div>Menu</div><section>{same}</section><div>{i}</div>" for i in range(40)] + [f"<div>Menu</div><section><p>{words(i)}</section><div>{i}</div>" for i in range(40, 52)]
    got = texts(spark, pages)
    assert all(" ".join(words(j) for j in range(3)) in got[i] for i in range(40)) and all(words(i) in got[i] for i in range(40, 52))
    assert not any("Menu" in t for t in got.values())


def test_a_host_of_copies_keeps_its_text(spark):
    got = texts(spark, [f"<div class=top>Head</div><p>{words(1)}"] * 12)
    assert set(got.values()) == {f"Head {words(1)}"}


def test_supplied_pages_keep_their_articles(spark):
    """What stands in the one article of a page is its text; on these pages no template may take a block of it."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.select("page_id", "html").collect()}
    for r in w.extract(pages).collect():
        page = w.read_page(html[r["page_id"]] or "")
        role = w.roles(w.skeleton(page))
        assert r["text"] == " ".join(t for n, t in page.blocks if role[n].main >= 0 and not role[n].out)
