"""Tables written between stages: the folder that all executors see, and columns that can't clash with a table's own."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``. Where that is unset, a folder of our own if everything
    runs in this machine's one process; on a cluster that is an error, as executors would not see each other's files."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors see (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="tidewire-")
    return _OWN[app]


_SCOPES: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the scope that it was made in ends, or the driver's interpreter."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    else:
        atexit.register(_drop, spark, path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written in this block are dropped at its end."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _drop(spark, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that ``make`` gives, written; the tables that were written on the way to it are dropped."""
    path = shared_path(spark, name)
    with scratch(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended before us
        pass


#: Rows that go to a Python worker at once where they are whole texts. Executor and worker each hold some batches.
TEXTS_AT_ONCE = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def rows_at_once(spark: SparkSession, n: int) -> Iterator[None]:
    """What runs in this block sends so many rows to a Python worker at once, or as many as the session says if those are fewer."""
    before = spark.conf.get(_BATCH)
    if 0 < int(before) <= n:
        yield
        return
    spark.conf.set(_BATCH, str(n))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def written(df: DataFrame, name: str, at_once: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and a lost executor loses none of it."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    with rows_at_once(spark, at_once) if at_once else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as one part, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``; their names may hold dots."""
    return [F.col(quoted(c)) for c in df.columns]


def spare_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    held = {c.lower() for c in df.columns}
    while wanted.lower() in held:
        wanted += "_"
    return wanted


#: Rows of a key from which on its sums are broadcast, and how many such keys there can be.
HOT_ROWS, HOT_KEYS = 256, 4096


def with_sums(rows: DataFrame, sums: DataFrame, key: str, n: str = "n", hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined (left) with ``sums``, a written table with a row for each ``key`` and the number ``n`` of its rows.

    A key of more than so many rows, and of more than a share of 1 / ``hot_keys`` of all, is broadcast: there can't be more
    than ``hot_keys`` of them. The others are joined by shuffle, so no task gets more than that of one key.
    """
    total = sums.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    least = max(hot_rows, total // hot_keys)
    others = [c for c in sums.columns if c not in (key, n)]
    hot = sums.filter(F.col(n) > least).select(F.col(key).alias("_hot_key"), F.struct(*others).alias("_hot"))
    rest = sums.filter(F.col(n) <= least).select(F.col(key).alias("_rest_key"), F.struct(*others).alias("_rest"))
    marked = rows.join(F.broadcast(hot), rows[key] == hot["_hot_key"], "left")
    plain = marked.filter("_hot_key is null").drop("_hot_key", "_hot").join(rest, F.col(key) == F.col("_rest_key"), "left")
    told = lambda side: [F.col(side)[c].alias(c) for c in others]
    spread = marked.filter("_hot_key is not null").select(*rows.columns, *told("_hot"))
    return plain.select(*rows.columns, *told("_rest")).unionByName(spread)


#: Rows up to which a table that stays small by its nature is broadcast.
SMALL_ROWS = 100_000


def join_small(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with a written table that has a row for each slot, range or the like: by broadcast up to so many
    rows, else by shuffle."""
    small = F.broadcast(small) if small.count() <= SMALL_ROWS else small
    return rows.join(small, keys, how)
