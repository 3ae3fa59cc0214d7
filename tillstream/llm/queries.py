"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    conversations,
    decontamination,
    fill_in_middle,
    licenses,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    substrings,
    token_counts,
    toxicity,
)
from tillstream.llm.common import table
from tillstream.llm.oracles import DECONTAMINATION, LICENSES
from tillstream.llm.oracles_texts import CONVERSATIONS, MIDDLES, SUBSTRINGS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op6_license_scans": LICENSES,
    "op7_benchmark_decontamination": DECONTAMINATION,
    "op11_substring_dedup": SUBSTRINGS,
    "op12_fill_in_middle": MIDDLES,
    "op13_conversation_repair": CONVERSATIONS,
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_rules.quality(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


@query
def op6_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


@query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The source is the host, and a source's texts of one language are a path."""
    return quality_classifier.quality_scores(
        table(spark, folder, "documents"),
        table(spark, folder, "labels"),
        F.col("source"),
        F.col("lang"),
    )


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fill_in_middle.fill_in_middle(table(spark, folder, "documents"))
    whole = fill_in_middle.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(whole, 256).alias("restored_sha256"),
    )


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")))
