"""Quality rules: base counts of a text, and lines that too many documents of a host share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

MIN_WORDS = 50
#: A line goes if more than MIN_DOCS documents of its host and more than MAX_SHARE of them hold it.
MIN_DOCS = 20
MAX_SHARE = 0.02
#: A document goes if fewer than MIN_WORDS words or less than KEPT_SHARE of its words are left.
KEPT_SHARE = 0.5
_SYMBOLS = b"#*$%&|<>"


def normal_line(line: bytes) -> bytes:
    """A-Z lower-cased, ASCII white space to one space, trimmed."""
    return b" ".join(line.lower().split())


def _line_hash(line: bytes) -> int:
    h = xxhash.xxh64_intdigest(line)
    return h - (1 << 64) if h >= 1 << 63 else h


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    repeated = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(many := Counter(windows)) < len(windows):
            twice = {w for w, c in many.items() if c > 1}
            end = 0  # words before this place are counted
            for i, w in enumerate(windows):
                if w in twice:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per host, text and distinct normal line with a word."""
    for batch in batches:
        hosts, lines, texts = [], [], []
        for host, text in zip(*(c.to_pylist() for c in batch.columns)):
            raw = (text or "").encode("utf-8", "surrogatepass")
            own = {_line_hash(x) for x in map(normal_line, raw.split(b"\n")) if x}
            hosts += [host] * len(own)
            lines += own
            texts += [_line_hash(raw)] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(lines, pa.int64()), pa.array(texts, pa.int64())], ["host", "line", "of_text"])


def frequent_lines(docs: DataFrame, host_col: str, text_col: str, min_docs: int, max_share: float) -> DataFrame:
    """``(host, lines)``: hashes of the lines above both limits, a row per host that has some.

    Copies of a text count as one document, so that a text does not lose its lines because it was copied. A host's list is short: it
    holds at most ``1 / max_share`` times the mean number of lines of its documents.
    """
    pairs = docs.select(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), text_col).mapInArrow(_lines_of, "host string, line long, of_text long")
    seen = materialize(pairs.distinct(), "lines")
    per_line = seen.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    per_host = seen.select("host", "of_text").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    over = per_line.join(per_host, "host").where(F.col("n") > max_share * F.col("docs"))
    return materialize(over.groupBy("host").agg(F.collect_list("line").alias("lines")), "frequent")


def _judge(min_words: int, kept_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words_left", "base_failed", "kept", "clean_text"]
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.string()]
        known: dict[tuple, frozenset] = {}
        for batch in batches:
            out = []
            for text, lines in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                n, chars, symbols, dup, repeated = base_counts(raw)
                left, clean = n, raw
                if lines:
                    bad = known.setdefault(tuple(lines), frozenset(lines))
                    rest = [x for x in raw.split(b"\n") if not (y := normal_line(x)) or _line_hash(y) not in bad]
                    clean = b"\n".join(rest)
                    left = len(clean.split())
                failed = n < min_words or 100 * repeated > 50 * n
                kept = not failed and left >= min_words and left >= kept_share * n
                out.append((n, chars, symbols, dup, repeated, left, failed, kept, None if text is None else clean.decode("utf-8", "surrogatepass")))
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["row", *names])

    return run


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_words: int = MIN_WORDS, kept_share: float = KEPT_SHARE) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but the text), the base counts, ``n_words_left``, ``base_failed``, ``kept`` and ``clean_text``.

    Lines are compared by the hash of their normal form; those above the limits go from ``clean_text``. A document that fails no
    base rule is rejected if it is depleted. NULL and empty texts have counts of 0 and fail; NULL hosts form a host of their own; repeated
    rows are judged alike and stay. An empty table gives an empty result; other columns are carried and may have any name.
    """
    require(docs, host_col, text_col)
    lists = frequent_lines(docs, host_col, text_col, min_docs, max_share)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("row"), F.col(text_col).alias("t"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("h"))
    both = rows.join(lists, rows["h"] == lists["host"], "left").select("row", "t", "lines")
    kind = both.schema["row"].dataType.simpleString()
    return both.mapInArrow(_judge(min_words, kept_share), f"row {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_words_left long, base_failed boolean, kept boolean, clean_text string")


def clean_documents(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The kept documents without their frequent lines, columns as in ``docs``; ``n_chars``, if there, follows the text."""
    kept = judge(docs, host_col, text_col).where("kept")
    columns = [F.col("clean_text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    out = kept.select(*columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words_left", "base_failed", "kept")


OP5_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM t
), win AS (
  SELECT r, i, list_slice(words, i, i + 2) AS g FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
  ) GROUP BY r
), line AS (
  SELECT r, host, text, l, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS norm
  FROM (SELECT r, host, text, unnest(lines) AS l FROM w)
), worded AS (SELECT * FROM line WHERE norm <> '')
, dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM worded GROUP BY r)
, docs_of AS (SELECT host, count(DISTINCT text) AS docs FROM worded GROUP BY host)
, bad AS (
  SELECT f.host, f.norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM worded GROUP BY host, norm) f JOIN docs_of d ON f.host = d.host
  WHERE n > {MIN_DOCS} AND n > {MAX_SHARE} * docs
), kept_words AS (
  SELECT r, sum(len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+'))) AS n_left FROM worded x
  WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.host = x.host AND bad.norm = x.norm) GROUP BY r
), counts AS (
  SELECT w.r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_left, 0) AS n_words_left
  FROM w LEFT JOIN rep ON w.r = rep.r LEFT JOIN dup ON w.r = dup.r LEFT JOIN kept_words k ON w.r = k.r
), judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_words_left AS BIGINT) AS n_words_left, base_failed,
  NOT base_failed AND n_words_left >= {MIN_WORDS} AND n_words_left >= {KEPT_SHARE} * n_words AS kept
FROM judged
"""
