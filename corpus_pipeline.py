"""From raw documents to packed sequences: toxic documents go, near-duplicates go, repeated passages go, the rest is packed.

Each stage reads what its predecessor wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerloom.llm import minhash, packing, suffixes, toxicity
from layerloom.llm.common import prepared, read, written
from layerloom.llm.queries import TOKENIZER

# Passages of this many words go although they are shorter than the bytes that suffixes.LENGTH asks for.
PASSAGE_WORDS = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted on the labelled ones among ``docs``, scores 0.5 or higher."""
    return toxicity.without_toxic(docs, read(prepared(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    prepared(spark)
    return minhash.one_of_each_class(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without the passages of 400 bytes or 50 words or more that occur elsewhere too; every document stays, if need be with an empty text."""
    prepared(spark)
    return suffixes.remove_repeats(docs, words=PASSAGE_WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, packed into sequences of 1024."""
    prepared(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("best_fit_packing", pack),
]

# A classifier, near-duplicates and packing are beyond SQL; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
