"""Exact histogram of encoded lengths.

Each task counts its documents by their number of tokens, and the counts are added up: one row for each
length that occurs. Suffix sums over the lengths answer, for every context limit, how many documents are longer,
how many tokens they hold, what is left when each is cut at the limit, and every quantile. The suffix sums go in
two steps, within blocks of lengths and over the blocks' totals, so no task reads all lengths.

Defined results: a null or empty text has length 0; repeated rows count each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memo import encoder, rank_order_suffices, texts_of, vocabulary_size
from .shared import whole_text, written

#: Lengths in a block of the suffix sums.
BLOCK = 64


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(length, documents): how many documents have that many tokens."""
    width = 2 if vocabulary_size(tokenizer) <= 1 << 16 else 4
    by_rank = rank_order_suffices(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts = encoder(tokenizer, width, by_rank).encode_all, Counter()
        for batch in batches:
            counts.update(len(ids) // width for ids in encode(texts_of(batch), width))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["length", "documents"])

    counted = docs.select(whole_text().alias("text")).mapInArrow(run, "length long, documents long")
    return counted.groupBy("length").agg(F.sum("documents").alias("documents"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs: documents and tokens in documents of at least L tokens, the same over all
    documents, the tokens that are left when every document is cut at L, and the share of documents of at most L."""
    block = F.floor(F.col("length") / BLOCK)
    rows = histogram.select("length", "documents", (F.col("length") * F.col("documents")).alias("tokens"), block.alias("block"))
    over = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    totals = rows.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t")).select(
        "block",
        F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t_above"),
        F.sum("d").over(all_).alias("all_documents"),
        F.sum("t").over(all_).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.join(totals, "block").select(
        "length", "documents", "tokens", "all_documents", "all_tokens",
        (F.col("d_above") + F.sum("documents").over(within)).alias("documents_from"),
        (F.col("t_above") + F.sum("tokens").over(within)).alias("tokens_from"),
    )
    return sums.select(
        "length", "documents", "tokens", "documents_from", "tokens_from", "all_documents", "all_tokens",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("documents_from")).alias("tokens_cut_at_length"),
        ((F.col("all_documents") - F.col("documents_from") + F.col("documents")) / F.col("all_documents")).alias("share_up_to"),
    )


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The histogram with its suffix sums, a row for each length that occurs."""
    return suffix_sums(written(lengths(docs, tokenizer), "lengths"))


def cut_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left when every document is cut at ``limit``, whether or not a document has that length. By the suffix
    sums of the next length that occurs: what is not in longer documents, and ``limit`` tokens of each of those."""
    longer = F.when(F.col("length") > limit, F.col("length"))
    at = sums.agg(F.max("all_tokens").alias("all"), F.min_by("tokens_from", longer).alias("tokens"), F.min_by("documents_from", longer).alias("documents"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return at.select((zero("all") - zero("tokens") + zero("documents") * limit).alias("tokens"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the least length that at least a share ``q`` of the documents do not exceed; null without documents."""
    return sums.filter(F.col("share_up_to") >= q).agg(F.min("length").alias("length"))
