"""The corpus pipeline: quality, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last return the columns
of ``documents``. ``run`` writes each stage's rows as Parquet in the shared folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import packing, quality, radix_dedup, simhash
from tidewire.llm.shared import TEXTS_AT_ONCE, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    return quality.keep_target(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return radix_dedup.keep_largest(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest doc_id."""
    return simhash.one_of_each_group(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and its offset there."""
    # in small parts, as executors hold what earlier stages left
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), at_once=1 << 20, rows_at_once=TEXTS_AT_ONCE)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("packing", packing_stage)]

#: Hashed n-gram models, SimHash and the tokenizers have no counterpart in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
