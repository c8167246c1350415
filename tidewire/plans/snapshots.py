"""How a snapshot of a table is cut into ranges of its key, and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import embedded

Range = tuple[int, int]


def is_splittable(kind: T.DataType) -> bool:
    """Whether a key can be cut into ranges: whole numbers only. Other tables are read by one task."""
    return isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType)


def single_key(keys: list[str]) -> str:
    """The one key column that change capture needs."""
    if len(keys) != 1:
        raise ValueError("a captured table needs a primary key" if not keys else f"a captured table needs a primary key of one column, not {', '.join(keys)}")
    return keys[0]


def split_ranges(least: int | None, most: int | None, n: int) -> list[Range]:
    """``n`` ranges of equal width, the last one up to ``most``; an empty table gives one range that holds nothing.

    With fewer keys than ranges the first ones hold nothing, and the last one everything.
    """
    if n <= 0:
        raise ValueError("there must be at least one range")
    if least is None or most is None:
        return [(0, -1)]
    size = (most - least + 1) // n
    return [(least + k * size, most if k == n - 1 else least + (k + 1) * size - 1) for k in range(n)]


def chunk_ranges(least: int | None, most: int | None, size: int) -> list[Range]:
    """Ranges of ``size`` keys, the last one up to ``most``; none for an empty table."""
    if size <= 0:
        raise ValueError("a chunk must have at least one key")
    if least is None or most is None:
        return []
    return [(a, min(a + size - 1, most)) for a in range(least, most + 1, size)]


def ranges_frame(table: DataFrame, key: str, n: int) -> DataFrame:
    """``split_ranges`` as a DataFrame (split, low, high), from the table's own bounds, without a stop at the driver."""
    bounds = table.agg(F.min(key).cast("long").alias("a"), F.max(key).cast("long").alias("b"))
    k = F.col("split").cast("long")
    size = F.floor((F.col("b") - F.col("a") + 1) / F.lit(n)).cast("long")
    rows = bounds.select("a", "b", size.alias("size"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("split"))
    return rows.filter("a is not null").select("split", (F.col("a") + k * F.col("size")).alias("low"), F.when(F.col("split") == n - 1, F.col("b")).otherwise(F.col("a") + (k + 1) * F.col("size") - 1).alias("high"))


def chunks_frame(table: DataFrame, key: str, size: int) -> DataFrame:
    """``chunk_ranges`` as a DataFrame (low, high)."""
    bounds = table.agg(F.min(key).cast("long").alias("a"), F.max(key).cast("long").alias("b")).filter("a is not null")
    return bounds.select("b", F.explode(F.sequence("a", "b", F.lit(size).cast("long"))).alias("low")).select("low", F.least(F.col("low") + size - 1, F.col("b")).alias("high"))


def split_of(key: str, ranges: list[Range]) -> F.Column:
    """The number of the range that holds a key, by arithmetic: all ranges but the last have one width."""
    least, width = ranges[0][0], max(1, ranges[0][1] - ranges[0][0] + 1)
    if ranges[0][1] < least:  # fewer keys than ranges
        return F.lit(len(ranges) - 1)
    return F.least(F.floor((F.col(key) - least) / width), F.lit(len(ranges) - 1)).cast("int")


def predicates(key: str, ranges: list[Range]) -> list[str]:
    """A condition for each range, for a partitioned read."""
    return [f"{key} BETWEEN {a} AND {b}" for a, b in ranges]


def read_snapshot(spark: SparkSession, url: str, table: str, key: str, n: int, properties: dict[str, str]) -> DataFrame:
    """A table by ranges of its key, or by one task where the key is no whole number."""
    url = embedded.address(spark, url)
    plain = spark.read.jdbc(url, table, properties=properties)
    if not is_splittable(plain.schema[key].dataType):
        return plain.sort(key)
    least, most = plain.agg(F.min(key), F.max(key)).first()  # one row
    return spark.read.jdbc(url, table, predicates=predicates(key, split_ranges(least, most, n)), properties=properties)
