"""Change capture by options: a snapshot of the tables, then their log, in one stream.

``spark.dataSource.register(ChangeSource)`` and ``spark.readStream.format("tidewire-changes")`` take the options of
``CdcOptions`` and, as a Python source has no connection of its own, where to get one: ``connect`` and ``push`` name functions
as ``module:function``. ``connect()`` gives a DB-API connection; ``push(start_lsn, slot_options)`` gives the rows (lsn, xid, data)
that the server sends. The log is read by push if that is given and opens, else by SQL peeks, or from files in ``path``.

The slot is prepared before the snapshot, so nothing falls between the two. The snapshot goes table by table and page by page
behind the last key, through the driver, with its place in the stream's offset; a large table's snapshot is better read as a
batch by ranges (``plans.snapshots``, or ``sources.exported`` where all readers see one state), and the stream started without one.

Offsets hold how far the log is done (``lsn``: the last commit up to which every transaction has ended) and how many rows were
read behind it. Rows of open transactions are kept in the state of ``reassemble_stream``, in Spark's checkpoint. ``commit``
acknowledges the ``lsn`` of the offset whose batch is in the sink, and nothing later, so after a restart the slot
stands where an offset says. After a lost connection the tables must have the same columns as before.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..functions import envelopes
from ..functions.dialect import slot_options
from ..functions.lsn import lsn_to_int
from ..functions.naming import qualified, quote, table_matches
from ..functions.options import CdcOptions, OptionError, named_function
from ..functions.records import json_record, parse_records
from ..operators.transactions import is_data
from ..plans.snapshots import single_key
from ..sources.exported import SNAPSHOT_XID
from ..sources.transport import FileTransport, PeekTransport, PushTransport, Row, Transport, discover_tables, first_that_opens, with_reconnect
from .log_source import MOST_ROWS, Reassembly, reassemble_stream

SCHEMA = "slot string, pos long, lsn string, xid long, data string"
_OWN = ("connect", "push", "path", "maxrowsperbatch")

_COLUMNS = "SELECT column_name, data_type FROM information_schema.columns WHERE table_schema = ? AND table_name = ? ORDER BY ordinal_position"
_TABLES = "SELECT table_schema, table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE'"
_KEYS = (
    "SELECT k.column_name FROM information_schema.table_constraints c JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name "
    "WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = ? AND c.table_name = ? ORDER BY k.ordinal_position"
)


class Tables:
    """The captured tables through a DB-API connection: names, columns, keys, and pages of rows."""

    def __init__(self, connect: Callable[[], Any], options: CdcOptions, mark: str = "?"):
        self.connect, self.options, self.mark, self.connection = connect, options, mark, None

    def rows(self, sql: str, *values: Any) -> list[tuple]:
        if self.connection is None:
            self.connection = self.connect()
        cursor = self.connection.cursor()
        try:
            cursor.execute(sql.replace("?", self.mark), values)
            return cursor.fetchall()
        finally:
            cursor.close()

    def names(self) -> list[tuple[str, str]]:
        return discover_tables([(s, t) for s, t, *_ in self.rows(_TABLES)], self.options.schema, self.options.table_name)

    def columns(self) -> dict[str, list[str]]:
        """What a table must still have after a lost connection, by a new one."""
        if self.connection is not None:
            with suppress(Exception):  # it may be the one that was lost
                self.connection.close()
            self.connection = None
        return {f"{s}.{t}": [" ".join(map(str, c)) for c in self.rows(_COLUMNS, s, t)] for s, t in self.names()}

    def page(self, table: tuple[str, str], after: Any, size: int) -> tuple[list[str], Any]:
        """The next rows of a table as log records, and the key of the last one."""
        columns = [(c, k) for c, k, *_ in self.rows(_COLUMNS, *table)]
        key = single_key([r[0] for r in self.rows(_KEYS, *table)])
        where = "" if after is None else f" WHERE {quote(key)} > ?"
        sql = f"SELECT {', '.join(quote(c) for c, _ in columns)} FROM {qualified(*table)}{where} ORDER BY {quote(key)} LIMIT {size}"
        rows = self.rows(sql, *([] if after is None else [after]))
        text = lambda v: None if v is None else str(v)
        records = [json_record(".".join(table), "INSERT", [(c, k, text(v)) for (c, k), v in zip(columns, row, strict=True)]) for row in rows]
        return records, rows[-1][[c for c, _ in columns].index(key)] if rows else None


class FileTables:
    """The same from files: lines of log records in a folder, all of one table."""

    def __init__(self, folder: str):
        self.files = FileTransport(folder)

    def names(self) -> list[tuple[str, str]]:
        return [("", "")] if self.files.files() else []

    def columns(self) -> dict[str, list[str]]:
        return {}

    def page(self, table: tuple[str, str], after: Any, size: int) -> tuple[list[str], Any]:
        rows = self.files.read(after or 0, size)
        return [r[3] for r in rows], (after or 0) + len(rows)


def _kind(data: str) -> tuple[str, int]:
    """What a record is, and a commit's sequence number: enough to tell how far the log is done."""
    if data.startswith("BEGIN"):
        return "BEGIN", 0
    if data.startswith("COMMIT"):
        csn = re.search(r"CSN (\d+)(?:\s|$)", data)
        return "COMMIT", int(csn.group(1)) if csn else 0
    return "INSERT", 0


class ChangeReader(SimpleDataSourceStreamReader):
    def __init__(self, options: CdcOptions, own: dict[str, str]):
        self.options, self.most = options, int(own.get("maxrowsperbatch", MOST_ROWS))
        connect = named_function(own["connect"]) if "connect" in own else None
        self.tables = Tables(connect, options) if connect else FileTables(f"{own['path']}/snapshot")
        makers: list[Callable[[], Transport]] = []
        if "push" in own:
            send = named_function(own["push"])
            asked = slot_options(options.parallel_decode_num, options.decode_style, options.sending_batch)
            makers.append(lambda: PushTransport(lambda start: send(start, asked)))
        if "path" in own:
            makers.append(lambda: FileTransport(f"{own['path']}/log"))
        elif connect:
            makers.append(lambda: PeekTransport(connect, options.slot_name, options.decode_plugin, options.parallel_decode_num))
        self.transport = first_that_opens(*makers)
        self.known: dict[str, list[str]] | None = None
        self.base: str | None = None  # where the slot stands
        self.behind: list[str] = []  # positions of the rows read behind it
        self.work = Reassembly()

    def initialOffset(self) -> dict:  # noqa: N802
        return {"phase": "new", "pos": 0}

    def _log(self, after: int, n: int) -> list[Row]:
        if self.known is None:
            self.known = self.tables.columns()
        return with_reconnect(self.transport, lambda t: t.read(after, n), self.tables.columns, self.known, start_lsn=self.base)

    def _moved(self, lsn: str | None) -> None:
        """The slot stands at ``lsn``: rows up to there are not read again."""
        done = lsn_to_int(lsn) or -1
        self.base, self.behind = lsn, [x for x in self.behind if (lsn_to_int(x) or 0) > done]

    def _take(self, rows: list[Row]) -> None:
        for pos, lsn, xid, data in rows:
            for _ in self.work.add(pos, lsn, xid, _kind(data)[1], _kind(data)[0], ""):
                pass
            self.behind.append(lsn)

    def _resume(self, start: dict) -> None:
        """In a new process: the slot goes to where the offset says, and what was read behind it is read again, for its
        transactions alone."""
        if self.base is None:
            self.work = Reassembly(start=start["lsn"])
            if lsn_to_int(start["lsn"]):
                self.transport.ack(start["lsn"])
            self._moved(start["lsn"])
            self._take(self._log(0, start["after"]))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at = dict(start)
        if at["phase"] == "new":
            # without a snapshot a slot that is there already goes on where it stands
            lsn = self.transport.prepare_slot() if self.options.snapshot_mode else "0/0"
            at = {"phase": "snapshot" if self.options.snapshot_mode else "log", "pos": 0, "lsn": lsn, "table": 0, "key": None, "after": 0}
        if at["phase"] == "snapshot":
            names, size = self.tables.names(), self.options.chunk_size
            found: list[tuple] = []
            while at["table"] < len(names) and (not found or len(found) + size <= self.most):  # pages, as a batch holds them whole
                records, key = self.tables.page(names[at["table"]], at["key"], size)
                found += [(self.options.slot_name, at["pos"] + k, at["lsn"], SNAPSHOT_XID, r) for k, r in enumerate(records)]
                last = len(records) < size
                at |= {"pos": at["pos"] + len(records), "table": at["table"] + last, "key": None if last else key}
            if found:
                return iter(found), at
            at |= {"phase": "log", "table": 0, "key": None}
        self._resume(at)
        rows = self._log(len(self.behind), self.most)
        if not rows:
            return iter([]), at if start["phase"] != "log" else start
        self._take(rows)
        lsn = self.work.last_lsn or at["lsn"]
        done = lsn_to_int(lsn) or -1
        end = at | {"pos": at["pos"] + len(rows), "lsn": lsn, "after": sum((lsn_to_int(x) or 0) > done for x in self.behind)}
        return self._numbered(rows, at["pos"]), end

    def _numbered(self, rows: list[Row], pos: int) -> Iterator[tuple]:
        return iter([(self.options.slot_name, pos + k, lsn, xid, data) for k, (_, lsn, xid, data) in enumerate(rows)])

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """A batch that was planned by a process that is gone."""
        n = end["pos"] - start["pos"]
        if end["phase"] != "log" or start["phase"] != "log":
            rows, reached = self.read(start)
            return itertools.islice(rows, n) if reached["pos"] >= end["pos"] else rows
        self._resume(start)
        rows = self._log(len(self.behind), n)
        self._take(rows)
        return self._numbered(rows, start["pos"])

    def commit(self, end: dict) -> None:
        """What lies before ``end`` is in the sink or in the query's state: the slot may move on to its ``lsn``."""
        if end["phase"] == "log" and (lsn_to_int(end["lsn"]) or 0) > (lsn_to_int(self.base) or 0):
            self.transport.ack(end["lsn"])
            self._moved(end["lsn"])


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewire-changes"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> ChangeReader:  # noqa: N802
        return ChangeReader(*parsed_options(dict(self.options)))


def parsed_options(options: dict[str, str]) -> tuple[CdcOptions, dict[str, str]]:
    """The capture's options, and those that say where its rows come from."""
    lower = {k.lower(): v for k, v in options.items()}
    own = {k: lower.pop(k) for k in _OWN if k in lower}
    if not own.get("connect") and not own.get("path"):
        raise OptionError("a capture needs a connection (connect) or a folder (path)")
    found = CdcOptions.of(lower)
    if not found.wal_mode:
        raise OptionError("wal.mode is off: a table is then polled, see streaming.polling")
    return found, own


def change_stream(spark: SparkSession, options: dict[str, str], keys: list[str] = (), snapshot_csn: int = -1) -> DataFrame:
    """The changes of the tables that the options name, in the order of their transactions. With ``output.format`` raw: slot, txn,
    pos, lsn, xid, commit_lsn, commit_csn, op, schema, table, before, after; with json: slot, txn, pos and ``event``.

    ``op`` is r for a snapshot's rows. The snapshot itself was read behind the slot's beginning, so a change may be in both;
    both give the same row by key; where the snapshot was read elsewhere and its number is known, ``snapshot_csn`` leaves out
    what it holds. ``keys`` are the names of the key columns that two of the JSON forms hold.
    """
    found, _ = parsed_options(options)
    spark.dataSource.register(ChangeSource)
    changes = parse_records(spark.readStream.format("tidewire-changes").options(**options).load())
    meant = table_matches(F.col("schema"), F.col("table"), found.schema, found.table_name)
    done = reassemble_stream(changes.filter(~is_data() | meant), snapshot_csn)
    kept = ["slot", "txn", "pos", "lsn", "xid", "commit_lsn", "commit_csn"]
    rows = parse_records(done, "record", kept)
    op = F.when(F.col("xid") == SNAPSHOT_XID, "r").when(F.col("type") == "INSERT", "c").when(F.col("type") == "UPDATE", "u").otherwise("d")
    rows = rows.select(*kept, op.alias("op"), "schema", "table", "before", "after")
    if found.output_format == "raw":
        return rows
    return rows.select("slot", "txn", "pos", event_of(found, list(keys)).alias("event"))


def event_of(options: CdcOptions, keys: list[str]) -> F.Column:
    """A change as text in the form that the options ask for; times are those of the formatting."""
    ms, database = envelopes.now_ms(), options.database
    op, before, after, table = F.col("op"), F.col("before"), F.col("after"), F.col("table")
    if options.json_format == "debezium":
        read = envelopes.debezium(op, before, after, database, F.col("schema"), table, ms, snapshot=True)
        return F.when(op == "r", read).otherwise(envelopes.debezium(op, before, after, database, F.col("schema"), table, ms, F.col("lsn")))
    if options.json_format == "canal":
        return envelopes.canal(op, before, after, database, table, keys, ms)
    return F.when(op == "r", envelopes.he(op, before, after, database, table, keys, ms)).otherwise(envelopes.he(op, before, after, database, table, keys, ms, F.col("lsn")))
