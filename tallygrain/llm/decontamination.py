"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items scans every text once."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygrain.llm.common import ASCII_LOWER, ASCII_UPPER, fresh, per_worker, require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

WINDOW = 10
#: Words of test items that one automaton holds, about; each costs some 2.5 kB of a worker's memory.
AUTOMATON_WORDS = 100_000
#: Words of a long item that are dealt out together; the next ones repeat the last WINDOW - 1 of them.
PIECE_WORDS = 10_000

#: The words of the contract, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TO_WORDS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def plain(text: str | None) -> bytes:
    """UTF-8 of a text, byte by byte: A-Z lower-cased, everything between words a space. Places stay those of the original."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER), F.lit(WORD), F.lit(0))


def automaton(pieces: Sequence[tuple[str, list[str]]], window: int):
    """Automaton over the windows of ``(item, words)``: its values are ``(number of words, items)``. None if there is no window."""
    import ahocorasick

    owners: dict[tuple, set] = {}
    for item, words in pieces:
        for i in range(max(1, len(words) - window + 1)):
            owners.setdefault(tuple(words[i : i + window]), set()).add(item)
    if not owners:
        return None
    out = ahocorasick.Automaton()
    for words, items in owners.items():
        out.add_word(f" {' '.join(words)} ", (len(words), sorted(items)))
    out.make_automaton()
    return out


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words, end excluded, without overlap."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _places(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as character offsets into the original text."""
    spans = [m.span() for m in re.finditer(rb"[^ ]+", raw)]
    upto = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]  # characters before a byte
    return [(int(upto[spans[a][0]]), int(upto[spans[b - 1][1]])) for a, b in runs]


def find(tree, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, runs of words that lie in occurrences, and the items with an occurring window."""
    words = plain(text).split()
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    matches = list(tree.iter(joined)) if tree is not None and words else []
    if not matches:
        return len(words), [], set()
    spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
    ends = np.searchsorted(spaces, [end for end, _ in matches]).tolist()
    return len(words), _merged([(end - n, end) for end, (_, (n, _)) in zip(ends, matches)]), set().union(*(items for _, (_, items) in matches))


_RUN = "struct<start:long,end:long>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(pieces: list[tuple[str, list[str]]], window: int, key: str, last: bool):
    names = ["row", "n_words", "runs", "spans", "items", *([] if last else ["text"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = per_worker("automaton", key, lambda: automaton(pieces, window))
        for batch in batches:
            _, texts, before, found = batch.columns
            n_words, runs, spans, items = [], [], [], []
            for text, old, known in zip(texts.to_pylist(), before.to_pylist(), found.to_pylist()):
                n, own, ids = find(tree, text)
                own = _merged([*own, *((r["start"], r["end"]) for r in old)])
                n_words.append(n)
                runs.append([{"start": a, "end": b} for a, b in own])
                spans.append([{"start": a, "end": b} for a, b in _places(plain(text), own)] if own and last else [])
                items.append(sorted(ids.union(known)))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, _RUNS), pa.array(spans, _RUNS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns if last else [*columns, texts], names)

    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_texts: Sequence[str] = ("text",), automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but the text), ``n_words``, ``runs``, ``spans`` and ``items`` per row of ``docs``.

    A window is ``window`` consecutive words of one of the columns ``item_texts`` of ``items`` (questions, answers), or all of them if there are
    fewer. ``runs`` are the document's words inside occurrences (from 0, end excluded, without overlap), ``spans`` the same as
    character offsets into the original text, ``items`` the sorted distinct ids, as strings, with an occurring window.

    NULL and empty texts have no words; a word-less item has no window; windows of items with a NULL id count, under the empty id; equal ids are
    one item; repeated rows are judged alike and stay. Texts of any length are scanned whole, a long item is cut into overlapping pieces. An
    empty table of documents gives an empty result, an empty table of items finds nothing. Other columns are carried in ``row``.

    Documents are neither shuffled nor sorted. The automaton travels to the workers; items of more words than ``automaton_words``, about, are
    dealt to several automata, and the documents are scanned by one after the other, so that its size is bounded.
    """
    require(docs, text_col)
    require(items, item_col, *item_texts)
    texts = F.array(*[F.struct(F.col(c).cast("string").alias("t")) for c in item_texts])
    worded = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.inline(texts)).select("item", words_of(F.col("t")).alias("w")).where(F.size("w") > 0).distinct()
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(PIECE_WORDS))
    pieces = worded.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, PIECE_WORDS + window - 1))).alias("w"))
    pieces = materialize(pieces.withColumn("n", F.size("w").cast("long")), "items")
    shards = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // automaton_words))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("row"))
    none = F.array().cast(f"array<{_RUN}>")
    frame = docs.select(rest.alias("row"), F.col(text_col).cast("string").alias("text"), none.alias("runs"), F.array().cast("array<string>").alias("items"))
    found = StructType.fromDDL(f"n_words long, runs array<{_RUN}>, spans array<{_RUN}>, items array<string>")
    found = StructType([frame.schema["row"], *found.fields])
    with_text = StructType([*found.fields, frame.schema["text"]])
    dealt = F.pmod(F.xxhash64("item", "w"), F.lit(shards))
    for shard in range(shards):
        own = [(r["item"], r["w"]) for r in pieces.where(dealt == shard).collect()]  # automaton_words of them, about
        last = shard == shards - 1
        frame = frame.select("row", "text", "runs", "items").mapInArrow(_scan(own, window, xxhash.xxh64_hexdigest(repr((window, own))), last), found if last else with_text)
        if not last:
            frame = materialize(frame, "scanned")
    return frame


def n_hit() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs, columns as they are."""
    scanned = fresh(docs, "scanned")
    found = contamination(docs.select("*", F.col(text_col).alias(scanned)), items, text_col=scanned, **options)
    return found.where(F.size("runs") == 0).select(*[F.col(f"row.`{c}`") for c in docs.columns])


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.array_join("items", ","), 256)
    return found.select("row.doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), (n_hit() > 0).alias("contaminated"))


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '{WORD}')"

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents
), b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, i, i + least(len(w), {WINDOW}) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (SELECT r, i, n, item FROM dw JOIN win USING (n, g)
), words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
), named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""
