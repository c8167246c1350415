"""The corpus operators' queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, ctph, length_histogram, licenses, packing, quality, radix_dedup, simhash, token_store, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"))
    rows = warc.assemble_written(warc.read_archives(archives, with_payload=False))
    number = lambda c, k: F.split(c, ":")[k].try_cast("long")
    told = F.col("metadata.fields")
    return rows.select(
        told["page_id"].try_cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", told["payload_bytes"].try_cast("long")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        number(F.col("response.refers_to"), 3).alias("refers_to"),
    )


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.neighbours(_table(spark, sf_dir, "documents"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_store(token_store.write_store(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1))


def op9_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.equal_texts(_table(spark, sf_dir, "documents"))


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.length_histogram(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_importance_resampling, op3_warc_transactions, op4_simhash_components, op5_license_scan,
        op6_byte_bpe, op7_piecewise_fingerprints, op8_token_store, op9_radix_dedup, op10_length_histogram,
    )
}

_OP9 = """
with normal as (
  select cast(doc_id as bigint) as doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id is not distinct from max(doc_id) over same as kept, sha256(text) as text_sha256
from normal window same as (partition by text)"""

SQL: dict[str, str] = {"op5_license_scan": licenses.scan_sql(), "op9_radix_dedup": _OP9}
