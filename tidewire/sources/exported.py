"""A snapshot that several readers share, and the number at which the log takes over.

One connection takes a lock, exports its snapshot and keeps its transaction open; readers, a task for each range of
keys, take that snapshot and see the same rows. The snapshot's sequence number tells which transactions it holds already: the
log is then read with that number, and drops them (``change_stream(..., snapshot_csn=...)``). Servers differ in what they
export; without a number (-1) a change may come twice, and both give the same row by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.dialect import SNAPSHOT_EXPORTS, advisory_lock, function_exists, import_snapshot, snapshot_id
from ..functions.naming import qualified, quote
from ..functions.options import OptionError, named_function
from ..functions.records import json_record
from ..plans.snapshots import Range, split_ranges

SCHEMA = "slot string, pos long, lsn string, xid long, data string"
#: The transaction number of a snapshot's rows.
SNAPSHOT_XID = -1


@dataclass(frozen=True)
class Exported:
    snapshot: str
    csn: int = -1


def _run(connection: Any, sql: str, *values: Any) -> list[tuple]:
    cursor = connection.cursor()
    try:
        cursor.execute(sql, values)
        return cursor.fetchall() if cursor.description else []
    finally:
        cursor.close()


@contextmanager
def exported(connect: Callable[[], Any], group: int) -> Iterator[Exported]:
    """A snapshot that holds while the block runs. The best way that the server knows is taken."""
    connection = connect()
    locked = False
    try:
        locked = bool(_run(connection, advisory_lock(group))[0][0])
        if not locked:
            raise RuntimeError(f"another reader of group {group} exports a snapshot")
        _run(connection, "BEGIN TRANSACTION ISOLATION LEVEL REPEATABLE READ")
        for needed, sql in SNAPSHOT_EXPORTS:
            if needed == SNAPSHOT_EXPORTS[-1][0] or _run(connection, function_exists(needed))[0][0]:
                name, csn = _run(connection, sql)[0]
                break
        yield Exported(snapshot_id(str(name)), -1 if csn is None else int(csn))
    finally:
        _run(connection, "ROLLBACK")
        if locked:
            _run(connection, advisory_lock(group, False))
        connection.close()


class _Split(InputPartition):
    def __init__(self, number: int, low: int | None, high: int | None):
        super().__init__(number)
        self.low, self.high = low, high


class SnapshotSource(DataSource):
    """``tidewire-snapshot``: rows of one table as log records, by ranges of a whole number, or by one task without ``splits``.

    Options: ``connect`` (module:function for a DB-API connection, called on the executors), ``schema``, ``table``, ``key``, ``columns``
    (name:type pairs, parted by commas), ``snapshot`` (optional), and ``splits``, ``low``, ``high``.
    """

    @classmethod
    def name(cls) -> str:
        return "tidewire-snapshot"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _SnapshotReader:
        return _SnapshotReader({k.lower(): v for k, v in self.options.items()})


class _SnapshotReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if missing := [n for n in ("connect", "schema", "table", "key", "columns") if not options.get(n)]:
            raise OptionError(f"missing options: {', '.join(missing)}")
        self.options = options
        self.columns = [tuple(c.rsplit(":", 1)) for c in options["columns"].split(",")]

    def partitions(self) -> list[InputPartition]:
        if "splits" not in self.options:
            return [_Split(0, None, None)]
        ranges: list[Range] = split_ranges(int(self.options["low"]), int(self.options["high"]), int(self.options["splits"]))
        return [_Split(k, *r) for k, r in enumerate(ranges)]

    def read(self, partition: _Split) -> Iterator[tuple]:
        o, connection = self.options, named_function(self.options["connect"])()
        try:
            if o.get("snapshot"):
                for sql in import_snapshot(o["snapshot"]):
                    _run(connection, sql)
            where = "" if partition.low is None else f" WHERE {quote(o['key'])} BETWEEN {partition.low} AND {partition.high}"
            cursor = connection.cursor()
            cursor.execute(f"SELECT {', '.join(quote(c) for c, _ in self.columns)} FROM {qualified(o['schema'], o['table'])}{where} ORDER BY {quote(o['key'])}")
            place = partition.value << 40
            while rows := cursor.fetchmany(1000):
                for row in rows:
                    values = [(c, k, None if v is None else str(v)) for (c, k), v in zip(self.columns, row, strict=True)]
                    yield o.get("slot", "main"), place, "0/0", SNAPSHOT_XID, json_record(f"{o['schema']}.{o['table']}", "INSERT", values)
                    place += 1
        finally:
            connection.close()


def read_exported(spark: SparkSession, options: dict[str, str], found: Exported | None = None) -> DataFrame:
    """The table's rows as log records; with ``found``, as that snapshot holds them. Read it while the snapshot is held."""
    spark.dataSource.register(SnapshotSource)
    return spark.read.format("tidewire-snapshot").options(**options, **({"snapshot": found.snapshot} if found else {})).load()
