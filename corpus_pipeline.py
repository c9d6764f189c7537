"""From raw documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallygrain.llm.common import ready, table
from tallygrain.llm.line_dedup import without_repeats
from tallygrain.llm.minhash_dedup import one_of_each
from tallygrain.llm.mixing import mixed_documents, weights_of
from tallygrain.llm.packing import pack, public_tokenizer
from tallygrain.llm.quality_rules import clean_documents
from tallygrain.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep the quality rules, without the lines that too many documents of their source share."""
    ready(spark)
    return clean_documents(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, within two edits, fewer for short lines; documents go of which nothing is left."""
    ready(spark)
    return without_repeats(docs, copies_from=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five-word shingles, Jaccard similarity of 0.8 or more.

    SimHash fingerprints and ball hashing link texts first, MinHash bands those that are beyond three bits; shingle sets decide.
    """
    ready(spark)
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of domains, languages and sources ask for them."""
    ready(spark)
    return mixed_documents(docs, weights_of(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    ready(spark)
    return pack(docs, public_tokenizer())


STAGES = [("quality", quality), ("repeated_lines", repeated_lines), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packing", packing)]

#: Tokens of a public tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
