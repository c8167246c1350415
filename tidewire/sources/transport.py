"""How a log is read: from files, or from a server through a DB-API connection.

A transport gives rows (pos, lsn, xid, data) behind a position and is told what is done with. Only the file transport
can be exercised without a server; the others take the connection from the caller, and the tests use stand-ins.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any, Protocol

from ..functions.dialect import peek_sql
from ..functions.lsn import lsn_to_int
from ..functions.naming import table_matches_text

Row = tuple[int, str, int, str]


class TransportError(RuntimeError):
    """The log could not be read."""


class Transport(Protocol):
    def open(self, start_lsn: str | None = None) -> None: ...

    def read(self, after: int, limit: int) -> list[Row]:
        """Up to ``limit`` rows behind the first ``after`` ones that have not been acknowledged."""

    def prepare_slot(self) -> str:
        """Makes sure that there is a slot before a snapshot is taken; the position that it starts from."""

    def ack(self, lsn: str) -> None: ...

    def drop(self) -> None: ...

    def close(self) -> None: ...


class FileTransport:
    """Replays a folder of files with a JSON object (pos, lsn, xid, data) on each line, in the order of their names. A read that
    goes on where the last one ended does not start from the front again, whatever was acknowledged in between."""

    def __init__(self, folder: str):
        self.folder, self.acked = Path(folder.removeprefix("file://").removeprefix("file:")), ""
        self._rewind()

    def _rewind(self) -> None:
        self._held: list[int] = []  # positions of the rows that were read behind the acknowledged one
        self._place: tuple[str, int] = ("", 0)  # the file and byte behind the last of them

    def open(self, start_lsn: str | None = None) -> None:
        self.acked = start_lsn or ""
        self._rewind()

    def files(self) -> list[Path]:
        return sorted(p for p in self.folder.glob("*.json*") if not p.name.startswith((".", "_")))

    def read(self, after: int, limit: int) -> list[Row]:
        if len(self._held) > after:
            self._rewind()
        done, (name, at) = lsn_to_int(self.acked), self._place
        rows: list[Row] = []
        for path in self.files():
            if path.name < name:
                continue
            with path.open("rb") as lines:
                start = at if path.name == name else 0
                lines.seek(start)
                while len(rows) < limit and (line := lines.readline()):
                    if not line.endswith(b"\n"):  # still being written
                        break
                    start += len(line)
                    r = json.loads(line)
                    place = lsn_to_int(r["lsn"]) or 0
                    if done is None or place > done:
                        self._held.append(place)
                        if len(self._held) > after:
                            rows.append((r["pos"], r["lsn"], r["xid"], r["data"]))
                    self._place = (path.name, start)
            if len(rows) >= limit:
                break
        return rows

    def prepare_slot(self) -> str:
        return self.acked or "0/0"

    def ack(self, lsn: str) -> None:
        done = lsn_to_int(lsn) or -1
        if done > (lsn_to_int(self.acked) or -1):
            self.acked, self._held = lsn, [x for x in self._held if x > done]

    def drop(self) -> None:
        self.acked = ""
        self._rewind()

    def close(self) -> None:
        pass


class PeekTransport:
    """Reads a slot by SQL without moving it; ``connect`` gives a DB-API connection. A peek starts at the slot's
    position every time, so rows that were read but not acknowledged are skipped."""

    def __init__(self, connect: Callable[[], Any], slot: str, plugin: str, parallel: int = 1, mark: str = "?"):
        self.connect, self.slot, self.plugin, self.parallel, self.mark, self.connection = connect, slot, plugin, parallel, mark, None

    def _rows(self, sql: str, *values: Any) -> list[tuple]:
        if self.connection is None:
            self.connection = self.connect()
        cursor = self.connection.cursor()
        try:
            cursor.execute(sql.replace("?", self.mark), values)
            return cursor.fetchall() if cursor.description else []
        finally:
            cursor.close()

    def _first(self, *calls: tuple) -> Any:
        """The first call that the server knows; servers differ in the functions' names."""
        failed: Exception | None = None
        for sql, *values in calls:
            try:
                rows = self._rows(sql, *values)
                return rows[0][0] if rows else None
            except Exception as error:
                failed = error
                if self.connection is not None and hasattr(self.connection, "rollback"):
                    self.connection.rollback()
        raise TransportError(f"slot {self.slot}: {failed}") from failed

    def exists(self) -> bool:
        return bool(self._rows("SELECT 1 FROM pg_replication_slots WHERE slot_name = ?", self.slot))

    def open(self, start_lsn: str | None = None) -> None:
        if not self.exists():
            self._rows("SELECT * FROM pg_create_logical_replication_slot(?, ?)", self.slot, self.plugin)
        if start_lsn:
            self.ack(start_lsn)

    def current_lsn(self) -> str:
        try:
            return self._first(("SELECT pg_current_xlog_location()",), ("SELECT pg_current_wal_lsn()",)) or "0/0"
        except TransportError:
            return "0/0"

    def prepare_slot(self) -> str:
        if self.exists():
            return self.current_lsn()
        rows = self._rows("SELECT * FROM pg_create_logical_replication_slot(?, ?)", self.slot, self.plugin)
        return rows[0][1] if rows and len(rows[0]) > 1 else self.current_lsn()

    def read(self, after: int, limit: int) -> list[Row]:
        rows = self._rows(peek_sql(after + limit, self.parallel), self.slot)[after:]
        return [(after + k, lsn, int(xid), data) for k, (lsn, xid, data) in enumerate(rows)]

    def ack(self, lsn: str) -> None:
        self._first(
            ("SELECT pg_replication_slot_advance(?, ?)", self.slot, lsn),
            ("SELECT pg_logical_replication_slot_advance(?, ?)", self.slot, lsn),
        )

    def drop(self) -> None:
        if self.exists():
            self._rows("SELECT pg_drop_replication_slot(?)", self.slot)

    def close(self) -> None:
        if self.connection is not None:
            self.connection.close()
            self.connection = None


class PushTransport:
    """A log that the server sends: ``start`` gives an iterator of (lsn, xid, data) from a position, and ``flush`` reports
    what is done. Rows stay here until they are acknowledged."""

    def __init__(self, start: Callable[[str | None], Iterator[tuple[str, int, str]]], flush: Callable[[str], None] = lambda _: None, most_batches: int = 100):
        self.start, self.flush, self.most, self.stream, self.held = start, flush, most_batches, None, []

    def open(self, start_lsn: str | None = None) -> None:
        self.stream, self.held = self.start(start_lsn), []

    def read(self, after: int, limit: int) -> list[Row]:
        if self.stream is None:
            self.open()
        for lsn, xid, data in itertools.islice(self.stream, max(0, min(after + limit - len(self.held), self.most * limit))):
            self.held.append((lsn, xid, data))
        return [(after + k, *row) for k, row in enumerate(self.held[after : after + limit])]

    def prepare_slot(self) -> str:
        return "0/0"

    def ack(self, lsn: str) -> None:
        done = lsn_to_int(lsn)
        if done is not None:
            self.flush(lsn)
            self.held = [r for r in self.held if (lsn_to_int(r[0]) or 0) > done]

    def drop(self) -> None:
        self.held = []

    def close(self) -> None:
        self.stream = None


def first_that_opens(*makers: Callable[[], Transport], start_lsn: str | None = None) -> Transport:
    """The first transport that opens: push, say, or else a peek."""
    failed: list[str] = []
    for make in makers:
        try:
            transport = make()
            transport.open(start_lsn)
            return transport
        except Exception as error:
            failed.append(str(error))
    raise TransportError("no transport opens: " + "; ".join(failed))


def with_reconnect(transport: Transport, call: Callable[[Transport], Any], columns: Callable[[], dict[str, list[str]]], known: dict[str, list[str]], tries: int = 3, start_lsn: str | None = None) -> Any:
    """``call`` again after a lost connection, if the tables still have the same columns; the transport opens again at
    ``start_lsn``, where the slot stands."""
    for k in range(tries):
        try:
            return call(transport)
        except Exception as error:
            if k == tries - 1:
                raise
            transport.close()
            transport.open(start_lsn)
            if (now := columns()) != known:
                changed = sorted(t for t in {*now, *known} if now.get(t) != known.get(t))
                raise TransportError(f"these tables have other columns than when the capture began: {', '.join(changed)}") from error
    return None


def discover_tables(tables: list[tuple[str, str]], schema: str, wanted: str) -> list[tuple[str, str]]:
    """The (schema, table) pairs that a table name or pattern means, sorted."""
    return sorted((s, t) for s, t in tables if table_matches_text(s, t, schema, wanted))
