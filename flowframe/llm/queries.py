"""The corpus operators bound to the test tables, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowframe.llm import (
    bpe, conversation_repair, hmm, hnsw, html_text, mixing, packing, periodic_runs, quality_model, quality_rules, resharding, simhash,
    substring)
from flowframe.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def word_vocabulary() -> str:
    """Where the installed vocabulary package keeps its lower-case word BPE file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_ranks() -> tuple[str, str]:
    """The installed byte-level rank file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


@register("op1_simhash")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_components(table(spark, d, "documents"), width=3, radius=3)


@register("op7_substring_dedup")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return substring.passage_digest(table(spark, d, "documents"))


@register("op2_mixing", mixing.MIX_SQL)
def op2(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(table(spark, d, "documents"))


@register("op4_bpe")
def op4(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, d, "documents"), word_vocabulary())


@register("op9_quality_classifier")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return quality_model.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


@register("op3_quality_rules")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(table(spark, d, "documents"))


@register("op10_lm_score")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return hmm.score_documents(table(spark, d, "documents"))


@register("op6_embedding_dedup")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, d, "embeddings"))


@register("op5_html_text")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract_pages(table(spark, d, "pages"))


@register("op8_token_packing")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), *byte_ranks())


@register("op11_periodic_runs")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, d, "documents"))


@register("op12_conversation_repair")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return conversation_repair.repair_report(table(spark, d, "conversations"))


@register("op13_resharding")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return resharding.shard_report(table(spark, d, "documents"))
