"""Stages from raw documents to packed training windows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cardtide.llm.common import table
from cardtide.llm.entries import quality_weights, toxicity_model
from cardtide.llm.lines import dedup_lines
from cardtide.llm.mixing import mixed_documents
from cardtide.llm.ngrams import one_of_each_group
from cardtide.llm.packing import pack
from cardtide.llm.toxicity import drop_toxic
from cardtide.scratch import new_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the ordinal model expects to be toxic."""
    return drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each kind of line; documents of which nothing is left go."""
    return dedup_lines(docs, drop_emptied=True)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares most of its five-word shingles."""
    return one_of_each_group(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents out by the target weights of their sources."""
    return mixed_documents(docs, quality=quality_weights(spark, sf_dir))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fill windows of 2,048 tokens; one row per piece."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("ngram join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]

# Fitted models and hashes of the engine decide on rows, which SQL cannot follow.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"{name.replace(' ', '_')}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
