"""A training-data pipeline over ``documents``: drop toxic texts, exact copies
and near copies, mix the sources, and encode what is left.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grimlake.llm import exact_dedup, mixing, ngram_join, piece_tokens, toxicity
from grimlake.llm.common import documents, stored
from grimlake.llm.queries import piece_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.reject(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 the one with the smallest doc_id."""
    return ngram_join.one_per_group(docs, shingle=5, similar=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row, repeats included."""
    return piece_tokens.encode_documents(docs, piece_model()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
          ("mixing", mix_sources), ("piece_tokens", encode)]
ORACLE_SQL = None  # the toxicity model is no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
