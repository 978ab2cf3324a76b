"""From raw documents to packed sequences: quality rules, near copies, repeated passages, packing."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larkspur.llm import debruijn, jaccard, packing, quality  # noqa: E402
from larkspur.llm.queries import WORD_TOKENIZER, tokenizer_path  # noqa: E402
from larkspur.llm.tables import scratch_path  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the trees."""
    return quality.keep(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.representatives(docs)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier."""
    return debruijn.without_passages(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences."""
    return packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER))


STAGES = [("quality rules", quality_stage), ("n-gram Jaccard join", copies_stage), ("substring dedup", passages_stage), ("packing", packing_stage)]
#: Trees and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
