"""A training corpus from raw documents: five stages, each one of the corpus operators.

Every stage takes the documents its predecessor kept, with the columns of
``documents``, and works on all of them; the last one adds the encoded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm import bpe, mixing, quality_model, simhash, substring
from flowframe.llm.common import stage, table
from flowframe.llm.queries import word_vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from the labelled documents that are here."""
    return quality_model.keep_accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    return simhash.keep_one(docs, width=3, radius=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 13 words that an earlier document holds go.

    A text that loses none stays as it is; one that loses all of its words
    stays as an empty text.
    """
    out = substring.dedup_passages(docs, keep_layout=True).withColumn("text", F.col("kept_text"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: not at all, once or several times."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix with its token ids, their number and the text they decode to."""
    return bpe.encode_texts(docs, word_vocabulary(), decoded_col="decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

#: Neither the classifier nor the hashes and merges can be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet into the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
