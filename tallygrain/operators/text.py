"""Pages and review text: node extraction, aligned review rows, tokens, term statistics, topics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.functions.scalars import label_lookup
from tallygrain.operators.relational import top_k
from tallygrain.session import discard, materialize, ship_by_value, short_lived_shuffles

ship_by_value(__name__)

# Entities decoded in extracted text, the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}

# The English stop words of Spark ML, contractions by the parts that TOKEN makes of them, and some more that are common in reviews; pass
# another list to change it.
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their
theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can
will just don should now ll re ve isn aren wasn weren haven hasn hadn doesn didn won wouldn shan shouldn mustn couldn cannot could let ought would
also get like one us""".split()

TOKEN = r"[\p{L}\p{N}_]{2,}"


# --- markup --------------------------------------------------------------------


def node_pattern(tag: str, css_class: str | None = None) -> str:
    """Pattern whose first group is the inner markup of a node, optionally of an exact class."""
    attributes = "[^>]*" if css_class is None else rf'[^>]*\bclass="{css_class}"[^>]*'
    return rf"(?s)<{tag}\b{attributes}>(.*?)</{tag}>"


def attribute_pattern(tag: str, attribute: str, css_class: str | None = None) -> str:
    """Pattern whose first group is an attribute value; a class may stand before or after it."""
    needed = "" if css_class is None else rf'(?=[^>]*\bclass="{css_class}")'
    return rf'<{tag}\b{needed}[^>]*\b{attribute}="([^"]*)"'


def all_matches(markup: Column, pattern: str) -> Column:
    return F.regexp_extract_all(markup, F.lit(pattern), F.lit(1))


def plain_text(markup: Column) -> Column:
    """Drop tags, decode entities, trim."""
    text = F.regexp_replace(markup, "<[^>]*>", "")
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(text)


def extract_nodes(pages: DataFrame, key: str, markup: str, patterns: dict[str, str]) -> DataFrame:
    """(key, node, pos, text) for every match of every named pattern, in page order."""
    found = F.array(*[F.struct(F.lit(n).alias("node"), all_matches(F.col(markup), p).alias("m")) for n, p in patterns.items()])
    nodes = pages.select(key, F.inline(found))
    return nodes.select(key, "node", F.posexplode("m").alias("pos", "raw")).select(key, "node", "pos", plain_text(F.col("raw")).alias("text"))


def sub_ratings(block: Column, label_pattern: str, value_pattern: str, wanted: Sequence[str]) -> list[Column]:
    """Value per wanted category of one rating block, NULL where the category is not rated."""
    labels = F.transform(all_matches(block, label_pattern), plain_text)
    return label_lookup(labels, all_matches(block, value_pattern), wanted)


def reviews_table(pages: DataFrame, key: str, markup: str, fields: dict[str, str], block: str, label: str, value: str, categories: dict[str, str]) -> DataFrame:
    """One row per review: node lists and sub-ratings of a page aligned by position, short lists padded with NULL.

    ``fields`` maps output columns to patterns; ``block`` finds one rating module per review, in which
    ``label`` and ``value`` give pairs; ``categories`` maps output columns to labels.
    """
    source = F.col(markup)
    lists = [all_matches(source, p).alias(c) for c, p in fields.items()]
    rated = F.transform(
        all_matches(source, block),
        lambda b: F.struct(*[v.alias(c) for c, v in zip(categories, sub_ratings(b, label, value, list(categories.values())))]),
    )
    rows = pages.select(key, *lists, rated.alias("_rated"))
    zipped = rows.select(key, F.posexplode_outer(F.arrays_zip(*fields, "_rated")).alias("pos", "r"))
    return zipped.where(F.col("pos").isNotNull()).select(
        key, "pos", *[plain_text(F.col(f"r.{c}")).alias(c) for c in fields], *[F.col(f"r._rated.{c}").alias(c) for c in categories]
    )


# Markup of review pages.
REVIEW_FIELDS = {
    "Summary": node_pattern("span", "summary"),
    "Date": attribute_pattern("time", "datetime", "date subtle small"),
    "OverallRating": attribute_pattern("span", "title", "value-title"),
    "Pros": node_pattern("p", " pros mainText truncateThis wrapToggleStr"),
    "Cons": node_pattern("p", " cons mainText truncateThis wrapToggleStr"),
}
REVIEW_BLOCK = r'(?s)<div\b[^>]*\bclass="subRatings module"[^>]*>(.*?)</ul>'
REVIEW_LABEL = node_pattern("div", "minor")
REVIEW_VALUE = attribute_pattern("span", "title", "gdBars gdRatings med ")
REVIEW_CATEGORIES = {
    "WorkLifeBalance": "Work/Life Balance",
    "CultureValues": "Culture & Values",
    "CareerOpportunities": "Career Opportunities",
    "CompBenefits": "Comp & Benefits",
    "SeniorManagement": "Senior Management",
}


def review_rows(pages: DataFrame, key: str = "page_id", markup: str = "html") -> DataFrame:
    """``reviews_table`` with the markup of review pages."""
    return reviews_table(pages, key, markup, REVIEW_FIELDS, REVIEW_BLOCK, REVIEW_LABEL, REVIEW_VALUE, REVIEW_CATEGORIES)


# --- terms ---------------------------------------------------------------------


def tokens(c: Column, stop: Sequence[str] = tuple(STOP_WORDS)) -> Column:
    """Lower-case words of two or more characters, stop words removed; NULL text gives no words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(list(stop)))


def term_rows(df: DataFrame, keys: Sequence[str], text: str, stop: Sequence[str] = tuple(STOP_WORDS)) -> DataFrame:
    """One row per word occurrence: (keys..., term)."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))
    return df.where(F.col(text).isNotNull()).select(*keys, F.explode(words).alias("term")).where(~F.col("term").isin(list(stop)))


def doc_term(df: DataFrame, key: str, text: str, min_df: int = 2, max_df: float = 0.8, stop: Sequence[str] = tuple(STOP_WORDS)) -> DataFrame:
    """(key, term, tf) for terms in at least ``min_df`` documents and at most the share ``max_df`` of them."""
    counts = term_rows(df, [key], text, stop).groupBy(key, "term").agg(F.count("*").alias("tf"))
    counts = materialize(counts, "term-counts")  # read twice, and the text is not parsed again
    documents = df.agg(F.count("*")).scalar()
    kept = counts.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * documents))
    return counts.join(materialize(kept, "vocabulary"), "term").select(key, "term", "tf", "df")


def vocabulary_sample(terms: DataFrame, n: int = 10) -> DataFrame:
    """n terms in the order of a hash: as good as random, and the same on every run."""
    return terms.select("term").distinct().orderBy(F.md5("term"), "term").limit(n)


def word_frequency(df: DataFrame, columns: Sequence[str], n: int = 5000, stop: Sequence[str] = tuple(STOP_WORDS)) -> DataFrame:
    """The n most frequent words of each text column: (side, term, n)."""
    parts = [term_rows(df.select(F.lit(c).alias("side"), c), ["side"], c, stop) for c in columns]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return top_k(stacked.groupBy("side", "term").agg(F.count("*").alias("n")), ["side"], "n", n, "none", ["term"])


# --- topics --------------------------------------------------------------------


@dataclass
class TopicModel:
    """Topics as tables: ``terms`` (term, one column ``w0``, ``w1``, ... per topic), ``documents`` (key, ``d0``, ...), and the weight of each topic."""

    k: int
    key: str
    terms: DataFrame
    documents: DataFrame
    totals: list[float]


#: Added to counts of topics in documents and of terms in topics, less one, as usual for this way of fitting.
DOCUMENT_PRIOR, TERM_PRIOR = 1.1, 1.1


#: Characters of the documents whose pairs are packed at once, and pairs of a cell, about.
BLOCK_CHARS, CELL_PAIRS = 8_000_000, 4_000_000
#: Pairs whose numbers are held at once.
CHUNK = 250_000
#: Values of the start, below START each, that share a whole number.
START, WORD = 1000, 6

_SUMS = "kind int, block int, part int, at binary, g binary"
_STATE = "kind int, i int, j int, sub int, at binary, g binary, total array<double>"
_WHOLE = "kind int, block int, g binary, total array<double>"
_PIECES = "i int, j int, sub int, sizes binary, terms binary, tf binary"


def _table(rows: list[dict], schema: str, **more: pa.DataType) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    return pa.Table.from_pylist(rows, pa.schema([*((c, kinds[t]) for c, t in (x.split() for x in schema.split(", "))), *more.items()]))


def _matrix(g: bytes, k: int) -> np.ndarray:
    return np.frombuffer(g).reshape(-1, k)


def _add(whole: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
    """Add rows of ``g`` to the rows ``at`` of ``whole``."""
    for t in range(g.shape[1]):
        whole[:, t] += np.bincount(at, g[:, t], len(whole))


def _cells(pairs: pa.Table, terms: pa.Table, k: int, row: Callable[[int], int]) -> pa.Table:
    """The pairs of some documents by block of terms, in ``kind`` 2, with the names of the documents, in 3, and the sums over the start; a document without a key takes part in these only.

    ``row`` tells the block of documents that these are in.
    """
    index = pc.index_in(pairs["term"].combine_chunks(), value_set=terms["term"].combine_chunks())
    held = index.is_valid()
    pairs, index, kind = pairs.drop(["term"]).filter(held), index.drop_null().to_numpy(), pairs["name"].type
    if not len(index):
        return _table([], _SUMS + ", " + _PIECES, names=pa.list_(kind))
    j, term = terms["block"].to_numpy()[index], terms["n"].to_numpy()[index]
    names = pairs["name"].combine_chunks().dictionary_encode("encode")
    at, tf, i = names.indices.to_numpy(), pairs["tf"].to_numpy().astype(np.int32), pairs["i"][0].as_py()
    known = names.dictionary.is_valid().to_numpy(zero_copy_only=False)
    words = [pairs[f"s{x}"].to_numpy() for x in range(-(-k // WORD))]
    del pairs, index, held
    order, rows = np.lexsort((term, at, j)), [{"kind": 3, "i": i, "names": names.dictionary.to_pylist()}]
    edges = np.flatnonzero(np.diff(j[order], prepend=-1, append=-1))
    for lo, hi in zip(edges, edges[1:]):
        cell = order[lo:hi]
        block = int(j[cell[0]])
        (own, d), (used, t) = (np.unique(x[cell], return_inverse=True) for x in (at, term))
        of_documents, of_terms = np.zeros((len(own), k)), np.zeros((len(used), k))
        for x in range(0, len(cell), CHUNK):
            c = cell[x : x + CHUNK]
            start = np.stack([(words[w // WORD][c] >> (10 * (w % WORD))) & 1023 for w in range(k)], axis=1) + 1.0
            start *= (tf[c] / start.sum(axis=1))[:, None]
            _add(of_documents, d[x : x + CHUNK], start)
            _add(of_terms, t[x : x + CHUNK], start)
        rows.append({"kind": 0, "block": i, "part": block, "at": own.astype(np.int32).tobytes(), "g": of_documents.tobytes()})
        rows.append({"kind": 1, "block": block, "part": row(i), "at": used.astype(np.int32).tobytes(), "g": of_terms.tobytes()})
        there = known[at[cell]]
        packed = {"sizes": np.bincount(d[there], minlength=len(own)).astype(np.int32), "terms": t[there].astype(np.int32), "tf": tf[cell[there]]}
        rows.append({"kind": 2, "i": row(i), "j": block, "sub": i} | {c: v.tobytes() for c, v in packed.items()} | {"at": rows[-2]["at"], "g": rows[-1]["at"]})
    return _table(rows, _SUMS + ", " + _PIECES, names=pa.list_(kind))


def _step(pairs: pa.Table, state: pa.Table, totals: Sequence[float], size: int) -> pa.Table:
    """Sums of a cell by document and by term: a pair's count is spread over the topics in proportion to those of its document and its term."""
    k, whole, rows = len(totals), np.asarray(totals) + size * (TERM_PRIOR - 1), []
    known, used, g = {}, np.empty(0, np.int32), np.empty((0, len(totals)))
    for x in state.to_pylist():
        if x["kind"] == 0:
            known[x["sub"]] = _matrix(x["g"], k) + (DOCUMENT_PRIOR - 1)
        else:
            used, g = np.frombuffer(x["at"], np.int32), (_matrix(x["g"], k) + (TERM_PRIOR - 1)) / whole
    of_terms = np.zeros(g.shape)
    for x in pairs.to_pylist():
        a, own = known[x["sub"]], np.searchsorted(used, np.frombuffer(x["used"], np.int32))
        documents = np.repeat(np.arange(len(a), dtype=np.int32), np.frombuffer(x["sizes"], np.int32))
        terms, tf, b = np.frombuffer(x["terms"], np.int32), np.frombuffer(x["tf"], np.int32), g[own]
        of_documents, of_own = np.zeros(a.shape), np.zeros(b.shape)
        for lo in range(0, len(tf), CHUNK):
            d, t = documents[lo : lo + CHUNK], terms[lo : lo + CHUNK]
            p = a[d] * b[t]
            p *= (tf[lo : lo + CHUNK] / p.sum(axis=1))[:, None]
            _add(of_own, t, p)
            first = int(d[0])
            _add(of_documents[first : int(d[-1]) + 1], d - first, p)
        of_terms[own] += of_own  # each place once
        rows.append({"kind": 0, "block": x["sub"], "part": x["j"], "at": x["at"], "g": of_documents.tobytes()})
    if len(pairs):
        rows.append({"kind": 1, "block": pairs["j"][0].as_py(), "part": pairs["i"][0].as_py(), "at": used.tobytes(), "g": of_terms.tobytes()})
    return _table(rows, _SUMS)


def _added(parts: DataFrame, k: int, whole: bool, row: Callable[[int], int]) -> DataFrame:
    """Sums of the cells added up by block: one row per block, or for each of its cells the sums that it needs, the block's total per topic on the first."""
    def add(rows: pa.Table) -> pa.Table:
        at = [np.frombuffer(x, np.int32) for x in rows["at"].to_pylist()]
        sums = np.zeros((max(int(x[-1]) for x in at) + 1, k))
        for x, g in zip(at, rows["g"].to_pylist()):
            sums[x] += _matrix(g, k)  # each place once
        kind, block, total = rows["kind"][0].as_py(), rows["block"][0].as_py(), sums.sum(axis=0).tolist()
        if whole:
            return _table([{"kind": kind, "block": block, "g": sums.tobytes(), "total": total}], _WHOLE)
        out, part = [], rows["part"].to_numpy()
        if kind == 0:
            out = [{"i": row(block), "j": int(j), "sub": block, "g": sums[x].tobytes()} for j, x in zip(part, at)]
        else:
            for i in np.unique(part):
                used = np.unique(np.concatenate([x for n, x in zip(part, at) if n == i]))
                out.append({"i": int(i), "j": block, "at": used.tobytes(), "g": sums[used].tobytes()})
        return _table([x | {"kind": kind, "total": None if n else total} for n, x in enumerate(out)], _STATE)

    return parts.groupBy("kind", "block").applyInArrow(add, _WHOLE if whole else _STATE)


def _rows_of(blocks: DataFrame, name: str, prefix: str, k: int) -> DataFrame:
    """(name, one column per topic) of blocks (names, g)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, g in zip(batch["names"], batch["g"].to_pylist()):
                yield pa.RecordBatch.from_arrays([names.values, *(pa.array(c) for c in _matrix(g, k).T.copy())], [name, *(f"{prefix}{t}" for t in range(k))])

    held = blocks.schema["names"].dataType.elementType.simpleString()
    return blocks.select("names", "g").mapInArrow(rows, f"`{name}` {held}, " + ", ".join(f"{prefix}{t} double" for t in range(k)))


def topic_model(df: DataFrame, key: str, text: str, k: int = 5, seed: int = 42, min_df: int = 2, max_df: float = 0.8, max_iter: int = 20):
    """Fit a topic model on term counts of all documents and all terms: (vocabulary, model, documents).

    Expectation maximization over the pairs of a document and a term: a pair's count is spread over the topics in proportion to those of its
    document and its term, and both are sums over their pairs again. Pairs are written once, in cells of a block of documents and a block of terms;
    an iteration takes the sums of both blocks to each cell and writes the new sums, never a number per pair. The driver sees one
    number a topic. The start is a hash of the pair, so that a fit repeats.
    """
    with short_lived_shuffles(df.sparkSession):
        return _topic_model(df, key, text, k, seed, min_df, max_df, max_iter)


def _topic_model(df: DataFrame, key: str, text: str, k: int, seed: int, min_df: int, max_df: float, max_iter: int):
    documents = materialize(df.select(key).distinct(), "documents")
    sized = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")).first()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = max(1, -(-sized["chars"] // BLOCK_CHARS))
    # Texts are dealt out by block, so that counts of their words need no shuffle of their own, and are parsed again for the cells.
    i = F.pmod(F.xxhash64(key), F.lit(packs)).cast("int").alias("i")
    dealt = df.select(i, F.col(key).alias("name"), text).repartition(max(2 * packs, partitions), "i")
    words = term_rows(dealt, ["i", "name"], text).groupBy("i", "name", "term").agg(F.count("*").alias("tf"))
    used = materialize(words.groupBy("i", "term").agg(F.count("*").alias("df")), "used-terms")
    kept = used.groupBy("term").agg(F.sum("df").alias("df"))
    vocabulary = materialize(kept.where((F.col("df") >= min_df) & (F.col("df") <= max_df * sized["n"])), "vocabulary")
    size, n_pairs = vocabulary.agg(F.count("*"), F.coalesce(F.sum("df"), F.lit(0))).first()
    # So many cells, and as many of them by terms as by documents if there were as many of these: then the fewest sums are copied.
    cells_wanted = max(1, -(-n_pairs // CELL_PAIRS))
    term_blocks = min(cells_wanted, max(1, round((cells_wanted * size / max(1, sized["n"])) ** 0.5)))
    document_blocks = min(packs, -(-cells_wanted // term_blocks))

    def row(pack: int) -> int:
        return pack * document_blocks // packs

    order = Window.partitionBy("block").orderBy("term")  # a block of terms
    terms = vocabulary.select("term", F.pmod(F.xxhash64("term"), F.lit(term_blocks)).cast("int").alias("block")).withColumn("n", F.row_number().over(order) - 1)
    terms = materialize(terms, "terms")

    start = [F.pmod(F.xxhash64(F.col("name").cast("string"), "term", F.lit(seed + t)), F.lit(START)) for t in range(k)]
    packed = [sum((F.call_function("shiftleft", s, F.lit(10 * t)) for t, s in enumerate(start[w : w + WORD])), F.lit(0).cast("bigint")) for w in range(0, k, WORD)]
    pairs = words.select("i", "name", "term", "tf", *[w.alias(f"s{x}") for x, w in enumerate(packed)])
    numbered = used.select("i", "term").join(terms, "term")
    names = f", names array<{df.schema[key].dataType.simpleString()}>"
    cells = pairs.groupBy("i").cogroup(numbered.groupBy("i")).applyInArrow(lambda x, y: _cells(x, y, k, row), f"{_SUMS}, {_PIECES}{names}")
    cells = materialize(cells, "cells")
    pieces = materialize(cells.where("kind = 2").select("i", "j", "sub", "sizes", "terms", "tf", "at", F.col("g").alias("used")), "pairs")
    listed = materialize(cells.where("kind = 3").select(F.col("i").alias("block"), "names"), "names")
    state = materialize(_added(cells.where("kind < 2").select("kind", "block", "part", "at", "g"), k, max_iter == 0, row), "topics")
    discard(cells)

    def totals() -> list[float]:
        return [float(x or 0.0) for x in state.where("kind = 1").agg(*[F.sum(F.col("total")[t]) for t in range(k)]).first()]

    def step(known: list[float]):
        return lambda x, y: _step(x, y, known, size)

    for n in range(1, max_iter + 1):
        parts = pieces.groupBy("i", "j").cogroup(state.groupBy("i", "j")).applyInArrow(step(totals()), _SUMS)
        before, state = state, materialize(_added(parts, k, n == max_iter, row), "topics")
        discard(before)
    of_document = _rows_of(listed.join(state.where("kind = 0").select("block", "g"), "block"), key, "d", k)
    if max_iter:  # pairs without a key take part in the start only
        of_document = of_document.where(F.col(key).isNotNull())
    by_block = terms.groupBy("block").agg(F.sort_array(F.collect_list("term")).alias("names"))
    of_term = _rows_of(by_block.join(state.where("kind = 1").select("block", "g"), "block"), "term", "w", k)
    of_document, of_term = materialize(of_document, "document-topics"), materialize(of_term, "term-topics")
    return vocabulary, TopicModel(k, key, of_term, of_document, totals()), documents


def _distribution(model: TopicModel, documents: DataFrame) -> DataFrame:
    """(key, w): shares of topics per document; equal ones without a term of the vocabulary."""
    counts = [F.coalesce(f"d{j}", F.lit(0.0)) + (DOCUMENT_PRIOR - 1) for j in range(model.k)]
    held = documents.join(model.documents, model.key, "left").select(model.key, F.array(*counts).alias("n"))
    return held.select(model.key, F.transform("n", lambda x: x / F.aggregate("n", F.lit(0.0), lambda s, y: s + y)).alias("w"))


def topic_weights(model: TopicModel, documents: DataFrame, key: str) -> DataFrame:
    """(key, topic, weight) for every document and topic."""
    return _distribution(model, documents).select(key, F.posexplode("w").alias("topic", "weight"))


def topic_words(model: TopicModel, vocabulary: DataFrame, n: int = 10) -> DataFrame:
    """(topic, rank, term, weight), the n heaviest words of each topic; ties in the order of terms."""
    size = vocabulary.count()
    cells = [F.struct(F.lit(j).alias("topic"), ((F.col(f"w{j}") + (TERM_PRIOR - 1)) / F.lit(model.totals[j] + size * (TERM_PRIOR - 1))).alias("weight")) for j in range(model.k)]
    rows = top_k(model.terms.select("term", F.inline(F.array(*cells))), ["topic"], "weight", n, "none", ["term"])
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")  # n rows a topic
    return rows.withColumn("rank", F.row_number().over(order)).select("topic", "rank", "term", "weight")


def assign_topic(model: TopicModel, documents: DataFrame, key: str) -> DataFrame:
    """The heaviest topic of each document, the first on ties."""
    return _distribution(model, documents).select(key, (F.array_position("w", F.array_max("w")) - 1).cast("int").alias("topic"))
