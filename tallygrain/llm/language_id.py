"""Language identification with n-gram filters whose slots hold one bit a language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.llm.common import require, ship_by_value, table
from tallygrain.session import materialize

ship_by_value(__name__)

#: Features of the model: n-grams of a language that were seen MIN_COUNT times and make up MIN_SHARE of its n-grams at least, so that
#: there are 1 / MIN_SHARE of them at most, whatever the corpus.
MIN_COUNT = 2
MIN_SHARE = 1e-6
#: A language contains an n-gram if its relative frequency there is this share of the highest one at least.
RATIO = 0.2
#: Slots a kept n-gram, and places an n-gram takes.
SLOTS_PER_GRAM = 16
HASHES = 3
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_SPACE = 32


def _letters() -> np.ndarray:
    """Which code points are letters; built once a worker."""
    cached = globals().get("_LETTERS")
    if cached is None:
        cached = globals()["_LETTERS"] = np.array([chr(i).isalpha() for i in range(0x110000)], bool)
    return cached


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter trigrams of all texts, and the index of each one's text.

    Letters are lower-cased, anything else parts words, and a word is padded by one space on either side.
    """
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])
    owner = np.r_[0, owner] if len(owner) else np.zeros(len(points), int)
    letter = _letters()[points]
    points = np.where(letter, points, _SPACE).astype(np.uint64)
    keep = letter | np.r_[True, letter[:-1]]  # of several spaces the first stays
    points, letter, owner = points[keep], letter[keep], owner[keep]
    if len(points) < 3:
        return np.empty(0, np.uint64), np.empty(0, int)
    codes = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    inner = letter[1:-1]
    return codes[inner], owner[1:-1][inner]


def _slots(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(codes * np.uint64(o)) >> np.uint64(64 - bits) for o in _ODD[:HASHES]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and n-gram, summed within the task as far as memory allows."""
    sums: dict[str, list[np.ndarray]] = {}

    def rows(names: list[str]) -> Iterator[pa.RecordBatch]:
        for lang in names:
            codes, n = sums.pop(lang)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        codes, owner = grams(batch.column(1).to_pylist())
        for lang in set(langs):
            mine, n = np.unique(codes[(langs == lang)[owner]], return_counts=True)
            if lang in sums:
                both = np.concatenate([sums[lang][0], mine])
                mine, place = np.unique(both, return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([sums[lang][1], n])).astype(np.int64)
            sums[lang] = [mine, n.astype(np.int64)]
        if sum(len(x[0]) for x in sums.values()) > 1_000_000:
            yield from rows(list(sums))
    yield from rows(list(sums))


class Model:
    """Slots of 64-bit masks (one column for each 64 languages), the languages, and each one's rate of false positives."""

    def __init__(self, langs: list[str], bits: int, masks: np.ndarray):
        self.langs, self.bits, self.masks = langs, bits, masks
        fill = [((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
        self.false_rate = np.array(fill) ** HASHES

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the share of n-grams that the language contains, corrected for false positives; n-grams per text."""
        codes, owner = grams(texts)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        out = np.zeros((len(texts), len(self.langs)))
        slots = _slots(codes, self.bits)
        for word in range(self.masks.shape[1]):
            column = self.masks[:, word]
            inside = column[slots[0]]
            for s in slots[1:]:
                inside = inside & column[s]
            for i in range(64 * word, min(len(self.langs), 64 * word + 64)):
                hit = (inside >> np.uint64(i % 64)) & np.uint64(1)
                out[:, i] = np.bincount(owner, weights=hit.astype(float), minlength=len(texts))
        raw = out / np.maximum(total, 1)[:, None]
        return np.clip((raw - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1), total


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", min_share: float = MIN_SHARE) -> Model:
    """Model from all given rows with a language and a text; counts cover all rows. The model is bounded by ``1 / min_share`` features a language."""
    require(rows, lang_col, text_col)
    labelled = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = materialize(labelled.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], 6, np.zeros((64, 1), np.uint64))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    total = F.create_map(*[F.lit(x) for lang in langs for x in (lang, float(totals[lang]))])
    shares = counts.where(F.col("n") >= MIN_COUNT).select("gram", number[F.col("lang")].alias("i"), (F.col("n") / total[F.col("lang")]).alias("p"))
    top = shares.groupBy("gram").agg(F.max("p").alias("most")).select(F.col("gram").alias("g"), "most")
    held = shares.join(top, F.col("gram") == F.col("g")).where((F.col("p") >= RATIO * F.col("most")) & (F.col("p") >= min_share))
    kept = materialize(held.select("gram", "i"), "features")
    n = max(1, kept.count())
    bits = max(6, int(np.ceil(np.log2(SLOTS_PER_GRAM * n / max(1, len(langs)))) + 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, i = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            mask = np.uint64(1) << (i % 64).astype(np.uint64)
            for s in _slots(codes, bits):
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int64)), pa.array((i // 64).astype(np.int32)), pa.array(mask.view(np.int64))], ["slot", "word", "mask"])

    set_slots = kept.mapInArrow(place, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros((1 << bits, (len(langs) + 63) // 64), np.uint64)
    masks[set_slots["slot"].to_numpy(), set_slots["word"].to_numpy()] = set_slots["mask"].to_numpy().view(np.uint64)
    return Model(langs, bits, masks)


def predict(rows: DataFrame, model: Model, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols``, ``lang_pred`` and ``score`` per row; ties go to the first language in order of name.

    ``lang_pred`` is ``und`` with score 0 if the text is NULL or has no letter, or if no language was learned.
    """
    require(rows, text_col, *id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(id_cols)).to_pylist()
            shares, total = model.shares(texts)
            known = (total > 0) & bool(model.langs)
            best = shares.argmax(axis=1) if model.langs else np.zeros(len(texts), int)
            langs = [model.langs[b] if k else "und" for b, k in zip(best, known)]
            score = [float(shares[i, best[i]]) if k else 0.0 for i, k in enumerate(known)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(id_cols)], pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*id_cols, "lang_pred", "score"])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in id_cols]
    return rows.select(*id_cols, text_col).mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the fold of a document is kept from learning; documents without an id are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred``, ``score`` per row, learned from the rows outside the held-out fold.

    Repeated rows are judged alike; NULL languages are not learned from; an empty table gives an empty result. Texts of any length are read whole. Other columns are ignored, whatever their names.
    """
    model = fit(docs.where(~held_out(F.col(id_col))), lang_col, text_col)
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model, [id_col, "held_out"])


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
