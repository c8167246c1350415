"""Relational tables over JDBC: scans, and sinks that append, upsert or delete."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Dialect, dialect_for
from ..functions.options import JdbcOptions
from ..operators.changelog import CREATED, DELETED, latest
from . import embedded


#: Rows of a page where automatic commits are off and no size is given.
FETCH = 1000


def _properties(options: JdbcOptions) -> dict[str, str]:
    found = {"user": options.username, "password": options.password or None, "driver": options.driver}
    return {k: v for k, v in found.items() if v}


def scan(spark: SparkSession, options: JdbcOptions, custom_schema: str | None = None) -> DataFrame:
    """The table as a DataFrame. Filters, columns, limits and, with a JDBC catalog, aggregates are pushed down; with the
    options ``scan.partition.*`` it is read by so many tasks. Rows come in pages of ``scan.fetch-size``, for which Spark
    turns automatic commits off where the database needs that; with ``scan.auto-commit`` off they always come in pages. A
    database in the driver's process is read as it is at this call (see ``embedded``)."""
    reader = spark.read.format("jdbc").options(url=embedded.address(spark, options.url), dbtable=options.table_name, **_properties(options))
    if fetch := options.fetch_size or (0 if options.auto_commit else FETCH):
        reader = reader.option("fetchsize", fetch)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if options.partition_column is not None:
        reader = reader.options(
            partitionColumn=options.partition_column, numPartitions=options.partition_num, lowerBound=options.lower_bound, upperBound=options.upper_bound
        )
    return reader.load()


def append(df: DataFrame, options: JdbcOptions) -> None:
    """Inserts all rows. Without a key a retried task may insert again."""
    df = df.coalesce(options.parallelism) if options.parallelism else df
    _insert(df, options, options.table_name, "append")


def _insert(df: DataFrame, options: JdbcOptions, table: str, mode: str) -> None:
    """Rows into a table that is made if need be; from the driver if only that reaches the database."""
    here = embedded.in_driver(df.sparkSession, options.url)
    rows = df.limit(0) if here else df  # the table alone
    rows.write.format("jdbc").options(url=options.url, dbtable=table, batchsize=options.buffer_rows, **_properties(options)).mode(mode).save()
    if here:
        embedded.insert(df, options.url, table, _properties(options), options.buffer_rows)


#: Gives a DB-API connection, on an executor.
Connect = Callable[[], Any]


def _in_batches(rows: Iterable[Row], size: int, interval_s: float = 0, now: Callable[[], float] = time.monotonic) -> Iterator[list[Row]]:
    """Batches of so many rows, or of what has come when the first of them has waited for so long (0: no limit)."""
    held: list[Row] = []
    since = now()
    for row in rows:
        if held and interval_s and now() - since >= interval_s:
            yield held
            held = []
        if not held:
            since = now()
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def _write(connect: Connect, sql: str, values: list[tuple], retries: int, timeout_s: float) -> None:
    """Tries again so many times, but not after so many seconds."""
    began = time.monotonic()
    for k in range(retries + 1):
        connection = None
        try:
            connection = connect()
            cursor = connection.cursor()
            cursor.executemany(sql, values)
            connection.commit()
            return
        except Exception:
            if connection is not None:
                connection.rollback()
            if k == retries or time.monotonic() - began >= timeout_s:
                raise
            time.sleep(min(2**k, 10) / 10)
        finally:
            if connection is not None:
                connection.close()


def write_changes(
    changes: DataFrame, connect: Connect, options: JdbcOptions, keys: list[str], order: list[str], dialect: Dialect | None = None,
    upsert_sql: str | None = None, delete_sql: str | None = None, mark: str = "?",
) -> None:
    """Writes a changelog (``_op`` and the columns): upserts and deletes by key, so that a batch that is written twice gives
    the same table. The changes are first reduced to the last one of each key by ``order``, as the order across tasks is
    not fixed and a batch deletes before it upserts."""
    if not order:
        raise ValueError("changes need columns that say which one of a key comes last")
    dialect = dialect or dialect_for(options.url)
    fields = [c for c in changes.columns if c != "_op" and c not in order]
    up = upsert_sql or dialect.upsert(options.table_name, fields, keys, mark, options.ignore_null)
    down = delete_sql or dialect.delete(options.table_name, keys, mark)
    size, interval, retries, timeout = options.buffer_rows, options.buffer_interval_ms / 1000, options.max_retries, options.connection_timeout_s

    def run(rows: Iterator[Row]) -> None:
        for batch in _in_batches(rows, size, interval):
            gone = [tuple(r[k] for k in keys) for r in batch if r["_op"] == DELETED]
            kept = [tuple(r[f] for f in fields) for r in batch if r["_op"] != DELETED]
            if gone:
                _write(connect, down, gone, retries, timeout)
            if kept:
                _write(connect, up, kept, retries, timeout)

    last = latest(changes, keys, order).select("_op", *fields)
    (last.repartition(options.parallelism, *keys) if options.parallelism else last).foreachPartition(run)


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A table by its options, as users write them."""
    return scan(spark, JdbcOptions.of(options))


def write_table(df: DataFrame, options: dict[str, str], keys: Sequence[str] = (), order: Sequence[str] = (), connect: Connect | None = None, **more: Any) -> None:
    """Writes to a table by its options: appends where it has no key, else upserts and deletes by key. Rows without an
    ``_op`` are upserts."""
    found = JdbcOptions.of(options)
    if not keys:
        append(df, found)
        return
    if connect is None:
        raise ValueError("a table with a key is written through a connection")
    changes = df if "_op" in df.columns else df.withColumn("_op", F.lit(CREATED))
    write_changes(changes, connect, found, list(keys), list(order), **more)


def stream_writer(connect: Connect, options: JdbcOptions, keys: list[str], order: list[str], **more: Any) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``."""
    return lambda batch, _: write_changes(batch, connect, options, keys, order, **more)


def merge_staged(
    rows: DataFrame, options: JdbcOptions, keys: list[str], execute: Callable[[str], None], staging: str, dialect: Dialect | None = None
) -> None:
    """Upserts by way of a staging table and one MERGE: one statement at the server, however many rows there are."""
    dialect = dialect or dialect_for(options.url)
    _insert(rows, options, staging, "overwrite")
    execute(dialect.merge(options.table_name, staging, rows.columns, keys, options.ignore_null))


def driver_execute(spark: SparkSession, url: str) -> Callable[[str], None]:
    """Executes SQL from the driver's JVM."""
    return lambda sql: embedded.execute(spark, url, sql)


def keyset_pages(
    read: Callable[[str, list], DataFrame], dialect: Dialect, table: str, fields: list[str], keys: list[str], size: int, start: Any = "1970-01-01 00:00:00"
) -> Iterator[DataFrame]:
    """Pages of a table behind a cursor over ``keys``; ``read`` runs SQL with its values. With two keys the first page is
    what lies behind ``start`` in the first key."""
    cursor: list | None = None
    while True:
        values = ([] if len(keys) == 1 else [start]) if cursor is None else cursor if len(keys) == 1 else [cursor[0], *cursor]
        page = read(dialect.keyset_page(table, fields, keys, size, first=cursor is None), values)
        last = page.agg(F.max(F.struct(*keys)), F.count("*")).first()
        if not last[1]:
            return
        yield page
        if last[1] < size:
            return
        cursor = list(last[0])
