"""The corpus pipeline: quality rules, toxicity, exact de-duplication,
near-duplicate removal and packing, in this order.

Each stage takes all rows its predecessor kept, written as Parquet to the
shared folder in between, so a lost executor only repeats tasks of one
stage. Stages that work in Python bound the bytes of their Arrow batches.
A table without rows passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, jaccard_join, packing, quality, toxicity
from ledgerlens.llm.queries import WORD_TOKENIZER
from ledgerlens.session import bound_arrow_batches, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    bound_arrow_batches(spark)
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go. The model learns
    from the labelled documents among its input that are not held out."""
    bound_arrow_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.8 or more, directly
    or through others, the one with the smallest doc_id stays."""
    bound_arrow_batches(spark)
    return jaccard_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    bound_arrow_batches(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_duplicates", near_stage),
    ("packing", packing_stage),
]

# Tokenizing and learned scores are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
