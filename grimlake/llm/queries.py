"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grimlake.llm import (byte_tokens, exact_dedup, fingerprints, hard_negatives, html_text, mixing, ngram_join, pii,
                          piece_tokens, substring_dedup, suffix_tree, toxicity, vector_codes)
from grimlake.llm.common import documents


def piece_model() -> str:
    import public_tokenizers
    return "file://" + public_tokenizers.path("piece_bpe_32k.model")


def op1_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.digests(piece_tokens.encode_documents(documents(spark, sf_dir), piece_model()))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
                        "spans", "n_added")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir)).drop("k", "h", "kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.detect(documents(spark, sf_dir), labels)


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(documents(spark, sf_dir))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.with_label_errors(vector_codes.compress(embeddings(spark, sf_dir)))


def op12_byte_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = "file://" + public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_tokens.digests(byte_tokens.encode_documents(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings(spark, sf_dir).withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_piece_tokens, op2_pii, op3_ngram_join, op4_substring_dedup, op5_toxicity, op6_suffix_tree, op7_html_text,
        op8_mixing, op9_fingerprints, op10_exact_dedup, op11_vector_codes, op12_byte_tokens, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_join": ngram_join.SQL, "op4_substring_dedup": substring_dedup.SQL, "op8_mixing": mixing.SQL,
            "op10_exact_dedup": exact_dedup.SQL, "op11_vector_codes": vector_codes.SQL,
            "op13_hard_negatives": hard_negatives.SQL}
