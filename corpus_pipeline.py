"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before it kept. All
but the last return the columns of ``docs``. Repeated rows, NULLs, empty texts and further columns
are handled as the operators' docstrings say; of no documents nothing is made.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import decontamination, packing, pii, quality_rules, simhash
from tillstream.llm.common import table
from tillstream.session import durable, remove_folder, shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return simhash.kept_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.masked_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: SQL has no tokenisers, SimHash or search; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder.

    Between stages the documents are written to the shared folder and read from there, so a lost
    executor costs at most a part of one stage. A stage's documents are deleted when the next
    stage's are written.
    """
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}_{name}")
        if i:
            remove_folder(spark, f"{folder}/{i - 1}_{STAGES[i - 1][0]}")
        docs = spark.read.parquet(f"{folder}/{i}_{name}")
    packed = durable(STAGES[-1][1](spark, docs, sf_dir))
    remove_folder(spark, folder)
    return packed
