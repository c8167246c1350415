"""Exact deduplication by most-significant-digit radix partitioning.

A digit is a run of successive bytes of the normalised text. Every round splits each group by its next digit:
the rows are counted per (group, digit), with partial counts before the shuffle, and a pair that occurs once is
a text of its own and done. So is a pair whose digit is shorter than the round's width: its texts have ended, and
they are equal byte for byte. The rest goes on, with the bytes behind the digit. Digits grow from round to
round, so the longest text of L bytes takes about log L rounds; no digest decides on equality.

A round's counts and its remaining rows are written to the shared folder. The join of rows to counts is between
two written tables, each hashed for it, so adaptive execution can split a group that holds a large share of
all rows; nothing is collected.

Defined results: a null text counts as empty, and empty texts are equal to each other; of equal texts the
largest doc_id stays (a row with a null doc_id stays only if all of them are null, and then one of them does not
differ from another); repeated rows are counted each (``keep_largest`` keeps one of them); an empty table gives no rows; other columns
are not read, and ``keep_largest`` hands them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import row_key, settled, whole_text, without_rows, written

#: Bytes in the first digit, and how many times as many the next one has.
FIRST, GROWTH = 64, 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(column: str = "text") -> Column:
    """The text with A-Z, and nothing else, in lower case."""
    return F.translate(whole_text(column), _UPPER, _LOWER)


def _grouped(active: DataFrame, carried: list[str]) -> DataFrame:
    """A row for each row of ``active`` (id, text, already normalised, and ``carried``): id, ``carried``, and keep_id, the
    largest id of the row's group, and group_size."""
    active = active.select("id", *carried, F.lit(0).cast("long").alias("part"), F.encode("text", "UTF-8").alias("rest"))
    width, done = FIRST, []
    while True:
        digit = F.substring("rest", 1, width).alias("digit")
        keyed = active.select("id", *carried, "part", digit, F.when(F.length("rest") >= width, F.col("rest").substr(F.lit(width + 1), F.length("rest"))).alias("rest"))
        counts = active.groupBy("part", digit).agg(F.count("*").alias("group_size"), F.max("id").alias("keep_id"))
        counts = written(counts.select("*", F.monotonically_increasing_id().alias("new_part")), "radix-counts")
        over = (F.col("group_size") == 1) | F.col("rest").isNull()
        split = keyed.join(counts, ["part", "digit"]).select(
            "id", "keep_id", "group_size", *carried, F.col("new_part").alias("part"), F.when(~over, F.col("rest")).alias("rest")
        )
        split = written(split, "radix-rows")
        done.append(split.filter("rest is null"))
        active = split.filter("rest is not null").select("id", *carried, "part", "rest")
        width *= GROWTH
        if active.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("id", *carried, "keep_id", "group_size")


def equal_texts(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id (the largest doc_id of its group), group_size, kept, text_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), normalised().alias("text"))
    out = _grouped(rows.select("id", "text", F.sha2("text", 256).alias("text_sha256")), ["text_sha256"])
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_largest(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the largest doc_id, and one of several
    with that doc_id. All columns stay as they are.

    The rounds carry texts and row keys alone. A row that goes is found again by its key (doc_id and 128 bits of hashes of its
    text, see ``row_key``), in one join with a narrow table."""
    key = row_key()
    largest = F.struct((~key["no_id"]).alias("has_id"), key["doc_id"].alias("doc_id"), key["h"].alias("h"), key["g"].alias("g"))

    def told() -> DataFrame:
        found = _grouped(docs.select(largest.alias("id"), normalised().alias("text")), []).filter("group_size > 1")
        rows = found.groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("id") == F.col("keep_id")).alias("kept"))
        return rows.filter("n > 1 or not kept")

    return without_rows(docs, settled(docs.sparkSession, told, "equal-rows"), largest)
