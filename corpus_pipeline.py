"""A corpus cleaned and tokenised in stages; each stage's rows are written and read again before the next one.

Every stage takes rows with nulls in any column, empty and very long texts, repeated rows, tables without rows and further
columns of any name. All stages but the last return the columns as they came.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, line_dedup, pieces, simhash
from tidemark.llm.common import shared_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null and empty texts too, or whose language is not recognised, go.

    Repeated rows are judged alike. Where no document names its language, those with a letter stay.
    """
    return langid.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one nearly or wholly go; the documents stay, also those that lose all their lines.

    Null texts stay null. Documents without doc_id are not looked at. Rows that repeat doc_id and text stay alike.
    """
    return line_dedup.without_repeated_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays, one row of it.

    Null, empty and blank texts are equal to each other. Documents without doc_id stay.
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of their doc_id.

    Null and empty texts hold none; documents without doc_id stay. Items without id or of fewer than five words, and null
    ones, are not looked for.
    """
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, one row per row; null texts count as empty."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The first, second, fourth and last stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
