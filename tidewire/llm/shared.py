"""What the corpus operators share: written intermediate tables, and the whole text of a row."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import TEXTS_AT_ONCE, join_small, own_columns, quoted, scratch, settled, shared_path, spare_name, with_sums, written

__all__ = ["TEXTS_AT_ONCE", "join_small", "own_columns", "quoted", "released", "row_key", "scratch", "settled", "shared_path", "spare_name", "whole_text", "with_sums", "without_rows", "written"]


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, for ``mapInArrow``, which gives free memory back to the machine at its end: a worker lives on, and waits beside
    the tasks of stages that need none."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
            trim(0)

    return go


def whole_text(column: str = "text") -> Column:
    """The text of a row; null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key() -> Column:
    """What tells a row from others: its doc_id, rows without one last, and 128 bits of hashes of its text. Rows that share all
    of these are equal in both."""
    id_ = F.col("doc_id").cast("long")
    text = whole_text()
    return F.struct(
        F.isnull(id_).alias("no_id"), F.coalesce(id_, F.lit(0).cast("long")).alias("doc_id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")
    )


def without_rows(docs: DataFrame, told: DataFrame, key: Column) -> DataFrame:
    """``docs`` without some rows. ``told`` (id, n, kept), a written table, has the ids (as ``key`` gives them) of rows that go, and
    of those that stay and are there ``n`` > 1 times: one of them stays."""
    id_ = spare_name(docs, "id")
    rows = docs.select(*own_columns(docs), key.alias(id_))
    rows = rows.join(told.filter("not kept").select(F.col("id").alias(id_)), id_, "left_anti")
    repeated = told.filter("kept and n > 1").select(F.col("id").alias(id_))
    if not repeated.isEmpty():
        one = rows.join(repeated, id_, "left_semi").dropDuplicates([id_])
        rows = rows.join(repeated, id_, "left_anti").unionByName(one)
    return rows.select(own_columns(docs))
