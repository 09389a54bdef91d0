"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, embed_dedup, langid, line_dedup, merkle, mixing, pieces, pii, quality, simhash, spelling, token_counts, toxicity
from tidemark.llm.common import table


def _documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", *more)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), budget=2048)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), threshold=0.95)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "quality"), threshold=0.3)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(_documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "toxic"), threshold=0.5)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_documents(spark, sf_dir))
    return found.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir, "lang"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether each one as it may have been tampered with still leads to the root."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    values = [F.col(c) for c in docs.columns]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("doc_id", "lang", merkle.leaf_of(*values).alias("leaf"), F.when(chosen, merkle.leaf_of(*values[:-1], lower)).alias("tampered"))
    found = merkle.manifest(leaves, group="lang", key="doc_id", more=("tampered",))
    folded = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir, "source"), weights=(5, 2, 1), share=1.5, most=2).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate"
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.occurrences(_documents(spark, sf_dir), least_length=6, deleted=199)
    return spelling.grouped(spelling.counted(found, least=5), factor=5)


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_embedding_dedup, op3_pii, op4_quality, op5_simhash, op6_toxicity, op7_decontamination, op8_line_dedup, op9_language_id, op10_sentencepiece, op11_merkle, op12_mixing, op13_spelling)
}
