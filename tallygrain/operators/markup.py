"""Nodes of pages by a tolerant reader: nested, unclosed and misplaced tags, comments, scripts, all named entities."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygrain.session import ship_by_value

ship_by_value(__name__)

# Fixed values of the HTML standard: elements without content, those whose content is no markup, those that end an
# open paragraph, and those that end an open one of their kind, up to the element that holds them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
ENDS_PARAGRAPH = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
hgroup hr main menu nav ol p pre search section table ul""".split())
ENDS_OWN = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass(frozen=True)
class Node:
    """Elements of a tag, optionally with exactly this class; their text, or the value of an attribute they have."""

    tag: str
    css_class: str | None = None
    attribute: str | None = None


def attributes(source: str) -> dict[str, str]:
    """Names in lower case, the first of equal ones, values decoded."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), html.unescape(m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""))
    return out


def read(page: str | None, nodes: Sequence[Node], blocks: Sequence[Node] = ()) -> tuple[list[list[tuple[int | None, str]]], int]:
    """Per node of ``nodes`` its finds in page order, each with the innermost open block it starts in, and the number of blocks.

    The text of a node is all text inside, also of nested nodes, without tags, comments, scripts and styles, entities decoded,
    spaces trimmed. An end tag closes the nearest open element of its name with all inside, one that is not open is passed over, and what is open
    at the end is closed there. A paragraph ends where an element begins that cannot stand in it, an item or a cell at the next one.
    """
    page = page or ""
    wanted = list(nodes) + list(blocks)
    by_tag: dict[str, list[int]] = {}
    for i, node in enumerate(wanted):
        by_tag.setdefault(node.tag.lower(), []).append(i)
    finds: list[list[list]] = [[] for _ in nodes]
    pieces: list[str] = []
    stack: list[tuple[str, list[tuple[list, int]], bool]] = []  # tag, finds that wait for its text, whether it opened a block
    is_open: Counter[str] = Counter()
    open_blocks: list[int] = []
    count = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag, waiting, block = stack.pop()
            is_open[tag] -= 1
            for find, start in waiting:
                find[1] = html.unescape("".join(pieces[start:])).strip(" ")
            if block:
                open_blocks.pop()

    def depth_of(tags: set[str] | frozenset, scope: set[str] | frozenset = frozenset()) -> int | None:
        if not any(is_open[t] for t in tags):
            return None
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in tags:
                return depth
            if stack[depth][0] in scope:
                return None
        return None

    at = 0
    while True:
        m = _TAG.search(page, at)
        pieces.append(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if (depth := depth_of({tag})) is not None:
                close(depth)
            continue
        if tag in ENDS_PARAGRAPH and (depth := depth_of({"p"}, {"td", "th", "button"})) is not None:
            close(depth)
        if tag in ENDS_OWN and (depth := depth_of(*ENDS_OWN[tag])) is not None:
            close(depth)
        waiting, opened = [], False
        held = attributes(m[3]) if tag in by_tag else {}
        for i in by_tag.get(tag, []):
            node = wanted[i]
            if node.css_class is not None and held.get("class") != node.css_class:
                continue
            if i >= len(nodes):
                opened = True
            elif node.attribute is None:
                find = [open_blocks[-1] if open_blocks else None, ""]
                finds[i].append(find)
                waiting.append((find, len(pieces)))
            elif node.attribute in held:
                finds[i].append([open_blocks[-1] if open_blocks else None, held[node.attribute]])
        if opened:
            open_blocks.append(count)
            count += 1
        stack.append((tag, waiting, opened))
        is_open[tag] += 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            content = page[at : end.start() if end else len(page)]
            if tag in ("title", "textarea") or waiting:
                pieces.append(content)
            at = end.end() if end else len(page)
            close(len(stack) - 1)
        elif tag in VOID or m[3].rstrip().endswith("/") and tag not in ENDS_PARAGRAPH:
            close(len(stack) - 1)
    close(0)
    return [[tuple(f) for f in own] for own in finds], count


def nodes_of(pages: DataFrame, key: str, markup: str, nodes: dict[str, Node]) -> DataFrame:
    """(key, node, pos, text) for every find of every named node, ``pos`` from 0 in page order per name; NULL pages have none."""
    kind = StructType([pages.schema[key], *StructType.fromDDL("node string, pos int, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, name, pos, text = [], [], [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                for node, own in zip(nodes, read(page, list(nodes.values()))[0]):
                    row += [i] * len(own)
                    name += [node] * len(own)
                    pos += range(len(own))
                    text += [t for _, t in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(name, pa.string()), pa.array(pos, pa.int32()), pa.array(text, pa.string())], kind.names)

    return pages.select(key, markup).mapInArrow(run, kind)


def ratings_of(pages: DataFrame, key: str, markup: str, block: Node, label: Node, value: Node, categories: dict[str, str]) -> DataFrame:
    """(key, block, one column per category): a row per block of a page, the value whose label is the category's; a page without a block has one row of NULLs."""
    found = _reviews(pages, key, markup, {}, block, label, value, categories, every=True)
    return found.withColumnRenamed("pos", "block")


def reviews_of(pages: DataFrame, key: str, markup: str, fields: dict[str, Node], block: Node, label: Node, value: Node, categories: dict[str, str]) -> DataFrame:
    """(key, pos, fields, categories): one row per review, aligned by position on the page, short lists padded with NULL.

    ``fields`` names the nodes of a review; ``block`` holds the ratings of one review, in which ``label`` and ``value`` give pairs.
    """
    return _reviews(pages, key, markup, fields, block, label, value, categories, every=False)


def _reviews(pages: DataFrame, key: str, markup: str, fields: dict[str, Node], block: Node, label: Node, value: Node, categories: dict[str, str], every: bool) -> DataFrame:
    kind = StructType([pages.schema[key], *StructType.fromDDL(", ".join(["pos int", *[f"`{c}` string" for c in [*fields, *categories]]])).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos = [], []
            cells: list[list] = [[] for _ in [*fields, *categories]]
            for i, page in enumerate(batch.column(1).to_pylist()):
                found, blocks = read(page, [*fields.values(), label, value], [block])
                rated = []
                for b in range(blocks):
                    labels, values = ([t for at, t in own if at == b] for own in found[-2:])
                    pairs = dict(reversed(list(zip(labels, values))))  # the first of equal labels
                    rated.append([pairs.get(c) for c in categories.values()])
                n = max([blocks, int(every), *(len(own) for own in found[:-2])])
                row += [i] * n
                pos += range(n)
                for cell, own in zip(cells, found[:-2]):
                    cell += [t for _, t in own] + [None] * (n - len(own))
                for k, cell in enumerate(cells[len(fields) :]):
                    cell += [r[k] for r in rated] + [None] * (n - blocks)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int32()), *(pa.array(c, pa.string()) for c in cells)], kind.names)

    return pages.select(key, markup).mapInArrow(run, kind)


# Markup of review pages.
REVIEW_FIELDS = {
    "Summary": Node("span", "summary"),
    "Date": Node("time", "date subtle small", "datetime"),
    "OverallRating": Node("span", "value-title", "title"),
    "Pros": Node("p", " pros mainText truncateThis wrapToggleStr"),
    "Cons": Node("p", " cons mainText truncateThis wrapToggleStr"),
}
REVIEW_BLOCK = Node("div", "subRatings module")
REVIEW_LABEL = Node("div", "minor")
REVIEW_VALUE = Node("span", "gdBars gdRatings med ", "title")
REVIEW_CATEGORIES = {
    "WorkLifeBalance": "Work/Life Balance",
    "CultureValues": "Culture & Values",
    "CareerOpportunities": "Career Opportunities",
    "CompBenefits": "Comp & Benefits",
    "SeniorManagement": "Senior Management",
}


def review_rows(pages: DataFrame, key: str = "page_id", markup: str = "html") -> DataFrame:
    """``reviews_of`` with the markup of review pages."""
    return reviews_of(pages, key, markup, REVIEW_FIELDS, REVIEW_BLOCK, REVIEW_LABEL, REVIEW_VALUE, REVIEW_CATEGORIES)
