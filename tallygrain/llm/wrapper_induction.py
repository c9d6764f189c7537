"""Main text of web pages by wrappers induced per host: constant nodes are template, varying slots are content."""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import host_of, require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

#: Constancy is judged where a node has text on MIN_PAGES different stories of its host, and on this share of them, at least.
MIN_PAGES = 5
MIN_SHARE = 0.01
#: A node is template if at most this share of its texts differ, a block of text if this share of the stories with its node holds it.
VARIETY = 0.2
CONSTANT = 0.5
#: Blocks of this many words and more tell stories apart, by the least hash of SHINGLE words, which near copies mostly share.
STORY_WORDS = 20
SHINGLE = 5
#: Runs of siblings that differ between two pages are matched with so many cells in memory at a time; the result does not depend on it.
TABLE_CELLS = 250_000
#: What the words of classes speak against stays if less than this share of a page's varying text stands elsewhere.
REMAINDER = 0.1
#: Text beside the articles of a page wins over them if it is so many times as long, and this long: they are teasers then.
TEASER_TIMES, TEASER_CHARS = 2, 200

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption head html legend td tbody tfoot th thead tr".split()) | {"hr", "table"}
SCOPE = frozenset("html table td th caption button object template".split())
#: An element that is still open ends where one of the same family starts; the search stops at the family's parent.
FAMILY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Elements and roles that are never part of an article, and words of class or id that speak against it.
BESIDE_TAGS = frozenset("nav footer aside button select option head title menu dialog search label datalist canvas audio video object".split())
BESIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer menu modal "
    "nav navbar navigation newsletter notice pagination popup promo promotion related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MAIN_TAGS = frozenset(("article", "main"))
MARKS = "!~+?"

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Page(NamedTuple):
    """``nodes``: depth and label of the block elements in page order, runs of equal siblings as one; ``blocks``: node and text in page order."""

    nodes: list[tuple[int, str]]
    blocks: list[tuple[int, str]]


def _mark(tag: str, attributes: dict[str, str], tokens: list[list[str]]) -> str:
    """``!``: never part of an article; ``~``: comments; ``+``: a whole class or id, or a form, that speaks against it; ``?``: a part of a class or id."""
    style = attributes.get("style", "")
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", style)
    if tag in BESIDE_TAGS or hidden or attributes.get("role") in BESIDE_ROLES:
        return "!"
    if tag in ("body", "html"):
        return ""
    whole = {t[0] for t in tokens if len(t) == 1}
    if tag in MAIN_TAGS:
        return "~" if whole & {"comment", "comments", "sidebar"} else ""
    if whole & COMMENT_WORDS:
        return "~"
    if tag == "form" or whole & BESIDE_WORDS:
        return "+"
    return "?" if any(not BESIDE_WORDS.isdisjoint(t) for t in tokens) else ""


def _label(tag: str, attributes: str) -> str:
    """Tag, words of its class and id, and its mark."""
    if not attributes or attributes.isspace():
        return tag + _mark(tag, {}, [])
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    tokens = [w for t in (found.get("class", "") + " " + found.get("id", "")).split() if (w := re.findall(r"[a-z]+", t))]
    return ".".join([tag, *sorted({w for t in tokens for w in t})]) + _mark(tag, found, tokens)


def read_page(source: str) -> Page:
    """Block tree and texts of a page, as forgiving as a browser in what matters to them: elements that are not closed, closed twice or cut off."""
    nodes: list[tuple[int, str]] = [(0, "")]
    last: list[int] = [-1]  # the latest child of each node
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", 0)]  # open elements and the node that takes their text
    text: list[str] = []

    def flush() -> None:
        if text:
            if words := entities.unescape("".join(text)).split():
                blocks.append((stack[-1][1], " ".join(words)))
            text.clear()

    def close(depth: int) -> None:
        if stack[-1][1] != stack[depth - 1][1]:
            flush()
        del stack[depth:]

    at = 0
    while match := _TAG.search(source, at):
        if match.start() > at:
            text.append(source[at : match.start()])
        at = match.end()
        slash, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            slash, tag, attributes = match[4], match[5], match[6]
            if tag is None:
                continue
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            if tag == "xmp":  # shown as it is
                text.append(" " + entities.escape(source[at : end.start() if end else len(source)]) + " ")
            at = end.end() if end else len(source)
            continue
        for own, stop in ([({"p"}, SCOPE)] if tag in CLOSES_P else []) + ([FAMILY[tag]] if tag in FAMILY else []):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in own:
                    close(depth)
                    break
                if stack[depth][0] in stop:
                    break
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ")
            continue
        label = _label(tag, attributes)
        if tag in BLOCK or label[-1] in MARKS:
            flush()
            parent = stack[-1][1]
            node = last[parent]
            if node < 0 or nodes[node][1] != label:
                node = len(nodes)
                nodes.append((nodes[parent][0] + 1, label))
                last.append(-1)
                last[parent] = node
            stack.append((tag, node))
        else:
            stack.append((tag, stack[-1][1]))
    if at < len(source):
        text.append(source[at:])
    flush()
    return Page(nodes, blocks)


def skeleton(page: Page) -> str:
    return "\n".join(f"{d} {label}" for d, label in page.nodes)


def _tree(text: str) -> tuple[list[str], list[list[int]]]:
    labels, children, path = [], [], []
    for line in text.split("\n"):
        depth, _, label = line.partition(" ")
        del path[int(depth) :]
        if path:
            children[path[-1]].append(len(labels))
        path.append(len(labels))
        labels.append(label)
        children.append([])
    return labels, children


def _shapes(labels: list[str], children: list[list[int]], numbers: dict[tuple, int]) -> list[int]:
    """Per node the number of its subtree, equal for equal ones and larger than those of its children."""
    shape = [0] * len(labels)
    for x in range(len(labels) - 1, -1, -1):
        shape[x] = numbers.setdefault((labels[x], *(shape[c] for c in children[x])), len(numbers))
    return shape


def _ends(left: tuple[int, ...], right: tuple[int, ...], forms: list[tuple]) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """Places of equal shapes at both ends, which are paired, and the places between them whose labels are on both sides."""
    low, least = 0, min(len(left), len(right))
    while low < least and left[low] == right[low]:
        low += 1
    high = 0
    while high < least - low and left[-1 - high] == right[-1 - high]:
        high += 1
    ends = [*zip(range(low), range(low)), *zip(range(len(left) - high, len(left)), range(len(right) - high, len(right)))]
    mine, theirs = ({forms[x][0] for x in side[low : len(side) - high]} for side in (left, right))
    a = [i for i in range(low, len(left) - high) if forms[left[i]][0] in theirs]
    b = [j for j in range(low, len(right) - high) if forms[right[j]][0] in mine]
    while a and b and left[a[-1]] == right[b[-1]]:
        ends.append((a.pop(), b.pop()))
    return ends, a, b


def _best(first: np.ndarray, left: list[int], right: np.ndarray, weights: dict[int, np.ndarray]) -> Iterator[np.ndarray]:
    """After each place on the left, the weight of the heaviest selection within the first 0, 1, 2, ... places on the right; ``first`` stands before them."""
    for x in left:
        now = first.copy()
        np.maximum(now[1:], first[:-1] + weights[x][right], out=now[1:])
        yield (first := np.maximum.accumulate(now))


def _heaviest(first: np.ndarray, left: list[int], right: np.ndarray, weights: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of the heaviest selection in which both places rise; of several, that whose last pair has the largest places, and so on to the first.

    Rows of weights are kept up to TABLE_CELLS, more are halved and made anew: this costs time, and changes neither the weight nor the choice.
    """
    if len(left) > 1 and len(left) * len(right) > TABLE_CELLS:
        half = len(left) // 2
        for middle in _best(first, left[:half], right, weights):
            pass
        late = _heaviest(middle, left[half:], right, weights)
        width = late[0][1] if late else len(right)
        return _heaviest(first[: width + 1], left[:half], right[:width], weights) + [(half + i, j) for i, j in late]
    rows = [first, *_best(first, left, right, weights)]
    out, width, weight = [], len(right), rows[-1][-1]
    for i in range(len(left) - 1, -1, -1):
        own = weights[left[i]][right[:width]]
        if len(at := np.flatnonzero((own > 0) & (rows[i][:width] + own == weight))):
            width = int(at[-1])
            weight = rows[i][width]
            out.append((i, width))
    return out[::-1]


@functools.lru_cache(maxsize=4096)
def align(own: str, reference: str) -> tuple[int, ...]:
    """For each node of ``own`` its partner in ``reference`` or -1, by simple tree matching: most pairs of equal labels that keep parents and order.

    Equal subtrees match whole; equal siblings at both ends are paired first, which loses nothing. What is left in the middle is matched
    by the same rule at any length: time grows with the product of both lengths, memory with their sum and the pairs of different shapes.
    """
    if own == reference:
        return tuple(range(own.count("\n") + 1))
    labels, children = _tree(own)
    others, grandchildren = _tree(reference)
    numbers: dict[tuple, int] = {}
    shapes = _shapes(others, grandchildren, numbers)
    width = len(numbers)
    shape = _shapes(labels, children, numbers)
    forms, size = list(numbers), []
    for form in forms:
        size.append(1 + sum(size[c] for c in form[1:]))
    weights: dict[int, np.ndarray] = {}  # per shape of ``own`` the pairs it makes with each shape of ``reference``; 0: other label or not known yet

    def open_pairs(left: list[int], right: list[int]) -> Iterator[tuple[int, int]]:
        named: dict[str, list[int]] = {}
        for y in dict.fromkeys(right):
            named.setdefault(forms[y][0], []).append(y)
        for x in dict.fromkeys(left):
            row = weights.setdefault(x, np.zeros(width, np.int32))
            for y in named.get(forms[x][0], ()):
                if x == y or len(forms[x]) == 1 or len(forms[y]) == 1:
                    row[y] = size[x] if x == y else 1
                elif not row[y]:
                    yield x, y

    weights[shape[0]] = np.zeros(width, np.int32)
    todo = [(shape[0], shapes[0])]
    while todo:  # without recursion: pages may be nested deeply
        s, t = todo[-1]
        if weights[s][t]:
            todo.pop()
            continue
        ends, a, b = _ends(forms[s][1:], forms[t][1:], forms)
        left, right = [forms[s][1 + i] for i in a], [forms[t][1 + j] for j in b]
        if missing := [*open_pairs(left, right)]:
            todo += missing
            continue
        best = np.zeros(len(right) + 1, np.int32)
        for best in _best(best, left, np.array(right, np.int64), weights):
            pass
        weights[s][t] = 1 + sum(size[forms[s][1 + i]] for i, _ in ends) + best[-1]
        todo.pop()
    partner, follow = [-1] * len(labels), [(0, 0)]
    while follow:
        x, y = follow.pop()
        partner[x] = y
        if shape[x] == shapes[y]:
            follow += zip(children[x], grandchildren[y])
        elif children[x] and grandchildren[y]:
            ends, a, b = _ends(forms[shape[x]][1:], forms[shapes[y]][1:], forms)
            right = np.array([forms[shapes[y]][1 + j] for j in b], np.int64)
            chosen = _heaviest(np.zeros(len(b) + 1, np.int32), [forms[shape[x]][1 + i] for i in a], right, weights)
            follow += [(children[x][i], grandchildren[y][j]) for i, j in ends + [(a[i], b[j]) for i, j in chosen]]
    return tuple(partner)


def _paths(text: str) -> list[str]:
    """Labels from the root to each node, numbered among equal siblings."""
    labels, children = _tree(text)
    out = [""] * len(labels)
    for x in range(len(labels)):
        seen: dict[str, int] = {}
        for c in children[x]:
            seen[labels[c]] = seen.get(labels[c], -1) + 1
            out[c] = f"{_hash(out[x])}/{labels[c]}#{seen[labels[c]]}"
    return out


@functools.lru_cache(maxsize=4096)
def slots(own: str, reference: str) -> tuple[int, ...]:
    """Slot of each node: its partner's place in ``reference``, or its own place if it has none there."""
    theirs = _paths(reference)
    return tuple(_hash(theirs[b]) if b >= 0 else _hash("~" + path) for b, path in zip(align(own, reference), _paths(own)))


def block_key(slot: int, text: str) -> int:
    """One block of text in a slot."""
    return _hash(f"{slot} {text}")


class Role(NamedTuple):
    """``out``: stands beside an article for good; ``main``: the innermost article or main element around the node, or -1."""

    parent: int
    mark: str
    out: bool
    main: int


@functools.lru_cache(maxsize=4096)
def roles(text: str) -> tuple[Role, ...]:
    """The role of each node of a skeleton."""
    out: list[Role] = []
    path: list[int] = []
    for line in text.split("\n"):
        depth, _, label = line.partition(" ")
        del path[int(depth) :]
        over = out[path[-1]] if path else Role(-1, "", False, -1)
        mark = label[-1] if label and label[-1] in MARKS else ""
        tag = label.rstrip(MARKS).split(".")[0]
        gone = over.out or mark == "!" or (tag == "header" and over.main < 0)
        main = len(out) if tag in MAIN_TAGS and not mark else over.main
        path.append(len(out))
        out.append(Role(path[-2] if len(path) > 1 else -1, mark, gone, main))
    return tuple(out)


def _weights(role: tuple[Role, ...], blocks: list[tuple[int, str]]) -> list[int]:
    """Characters of ``blocks`` in the subtree of each node."""
    out = [0] * len(role)
    for n, t in blocks:
        out[n] += len(t)
    for n in range(len(role) - 1, 0, -1):
        out[role[n].parent] += out[n]
    return out


def _story(role: tuple[Role, ...], blocks: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """What marks and main elements leave of the blocks; a mark is overruled where it would take most of the page's text."""
    for marks in ("~", "+", "?"):
        marked = [n for n, r in enumerate(role) if r.mark and r.mark in marks and not r.out]
        if not marked or not blocks:
            continue
        weight = _weights(role, blocks)
        own = {n for n, r in enumerate(role) if r.main == n and weight[n]}  # main elements with text
        dropped = [False] * len(role)
        inside = [0] * len(role)  # text of main elements below a node
        for m in own:
            up = m
            while up >= 0:
                inside[up] += 1
                up = role[up].parent
        for n in marked:
            left = weight[0] - weight[n]
            elsewhere = not inside[n] and any(m not in _above(role, n) for m in own)
            least = {"~": 0, "+": REMAINDER * weight[0], "?": 0.5 * weight[0]}[role[n].mark]
            dropped[n] = bool(left) and (elsewhere or left >= least)
        for n, r in enumerate(role):
            dropped[n] = dropped[n] or (r.parent >= 0 and dropped[r.parent])
        blocks = [(n, t) for n, t in blocks if not dropped[n]]
    inner = [(n, t) for n, t in blocks if role[n].main >= 0]
    within, whole = sum(len(t) for _, t in inner), sum(len(t) for _, t in blocks)
    teaser = whole - within > max(TEASER_CHARS, TEASER_TIMES * within)
    return blocks if not inner or teaser else inner


def _above(role: tuple[Role, ...], n: int) -> set[int]:
    out = set()
    while n >= 0:
        out.add(n)
        n = role[n].parent
    return out


def main_text(page: Page, reference: str | None, template: frozenset[int]) -> str:
    """Blocks that are not template, without those whose elements stand beside an article.

    ``template`` holds slots and block keys. If nothing is left, as where every page of a host is a copy, constant blocks count as well.
    """
    own = skeleton(page)
    role = roles(own)
    blocks = [(n, t) for n, t in page.blocks if not role[n].out]
    story: list[tuple[int, str]] = []
    if reference is not None and template:
        slot = slots(own, reference)
        story = _story(role, [(n, t) for n, t in blocks if slot[n] not in template and block_key(slot[n], t) not in template])
    return " ".join(t for _, t in story or _story(role, blocks))


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _identity(page: Page) -> int:
    """Tells stories apart: the least hash of SHINGLE words in long blocks, of the longest block if there is none."""
    long = [words for _, t in page.blocks if len(words := t.split()) >= STORY_WORDS]
    if not long:
        return _hash(max((t for _, t in page.blocks), key=lambda t: (len(t), t), default=""))
    return min(_hash(" ".join(words[i : i + SHINGLE])) for words in long for i in range(len(words) - SHINGLE + 1))


_SLOT = pa.list_(pa.struct([("slot", pa.int64()), ("block", pa.int64())]))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [skeleton(read_page(source or "")) for source in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "skeleton"])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its story and the distinct blocks of its slots."""
    for batch in batches:
        stories, found = [], []
        for source, reference in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            page = read_page(source or "")
            slot = slots(skeleton(page), reference)
            found.append([{"slot": x, "block": y} for x, y in {(slot[n], block_key(slot[n], t)) for n, t in page.blocks}])
            stories.append(_identity(page))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stories, pa.int64()), pa.array(found, _SLOT)], ["host", "story", "slots"])


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES, variety: float = VARIETY, constant: float = CONSTANT) -> DataFrame:
    """``(host, reference, template)``: a host's most frequent skeleton, and the constant slots and blocks of all its layouts.

    Every page is aligned with the reference; nodes without a partner there are slots of their own, so that minor layouts have a template too.
    A slot is constant if few of its texts differ, a block if most of the stories with its slot hold it, wherever it stands in a run of
    equal siblings. Stories, not pages, are counted: copies and most near copies are one. Counts are taken by hash before they are shuffled, so
    that a host with a third of all pages is no larger a task than others. A list is bounded, as a slot must be on MIN_SHARE of the stories.
    """
    at = pages.select(host_of(F.col(url_col)).alias("host"), html_col)
    kinds = at.mapInArrow(_skeletons, "host string, skeleton string").groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    reference = kinds.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "skeleton")).alias("m")).select("host", F.col("m.skeleton").alias("reference"))
    reference = materialize(reference, "reference")
    found = at.join(reference, "host").select("host", html_col, "reference").mapInArrow(_slots, "host string, story long, slots array<struct<slot:long,block:long>>")
    seen = materialize(found.select("host", "story", F.inline("slots")).distinct(), "blocks")
    stories = seen.groupBy("host", "story").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("stories"))
    held = seen.groupBy("host", "slot", "story").agg(F.count("*").alias("n")).groupBy("host", "slot").agg(F.count("*").alias("held"))
    blocks = seen.groupBy("host", "slot", "block").agg(F.count("*").alias("n"))
    per_slot = blocks.groupBy("host", "slot").agg(F.sum("n").alias("uses"), F.count("*").alias("texts"))
    judged = per_slot.join(held, ["host", "slot"]).join(stories, "host").where((F.col("held") >= min_pages) & (F.col("held") >= MIN_SHARE * F.col("stories")))
    judged = materialize(judged.withColumn("whole", F.col("texts") <= F.greatest(F.lit(1), F.col("uses") * variety)), "judged")
    single = blocks.where(F.col("n") >= min_pages).join(judged.where("not whole"), ["host", "slot"]).where(F.col("n") >= constant * F.col("held")).select("host", F.col("block").alias("key"))
    keys = judged.where("whole").select("host", F.col("slot").alias("key")).unionByName(single)
    return materialize(reference.join(keys.groupBy("host").agg(F.sort_array(F.collect_set("key")).alias("template")), "host"), "wrappers")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` per row of ``pages``.

    NULL and empty html have an empty text. URLs without a host form a host of their own. Repeated rows give the same text; hosts with too few pages
    for a wrapper go by elements, roles and class words alone; an empty table gives an empty result; other columns are ignored. Class words
    decide only where they leave the page's main text in place. Pages of any length are read whole. Wrappers are joined by
    host, broadcast only if Spark has measured them to be small.
    """
    require(pages, id_col, url_col, html_col)
    wrappers = induce(pages, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, reference, template in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                texts.append(main_text(read_page(source or ""), reference, frozenset(template or ())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col), host_of(F.col(url_col)).alias("own_host"))
    joined = rows.join(wrappers, rows["own_host"] == wrappers["host"], "left").select(rows[id_col], rows[url_col], rows[html_col], "reference", "template")
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col))
    return joined.mapInArrow(run, f"{kinds}, text string, n_chars long")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
