"""A log as a streaming source, and transactions that are put together across micro-batches.

``spark.dataSource.register(LogSource)`` makes ``spark.readStream.format("tidewire-log").option("path", folder)``
read a folder of log files. Its offset is the number of rows read; Spark keeps it in the query's checkpoint, so
a restart goes on behind the last batch that was committed, and ``commit`` passes on what is done with.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.lsn import lsn_to_int
from ..functions.options import OptionError
from ..sources.transport import FileTransport

SCHEMA = "slot string, pos long, lsn string, xid long, data string"
MOST_ROWS = 10_000


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewire-log"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, str, int]:
        options = {k.lower(): v for k, v in self.options.items()}
        if not options.get("path"):
            raise OptionError("missing options: path")
        most = int(options.get("maxrowsperbatch", MOST_ROWS))
        if most <= 0:
            raise OptionError("option maxRowsPerBatch must be above 0")
        return options["path"], options.get("slot.name", "main"), most

    def simpleStreamReader(self, schema) -> LogStreamReader:  # noqa: N802
        return LogStreamReader(*self._options())

    def reader(self, schema) -> LogReader:
        return LogReader(*self._options())


class LogReader(DataSourceReader):
    """All of the log, a file for each task."""

    def __init__(self, path: str, slot: str, most: int):
        self.path, self.slot = path, slot

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in FileTransport(self.path).files()] or [InputPartition("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value:
            with open(partition.value, encoding="utf-8") as lines:
                for r in map(json.loads, lines):
                    yield self.slot, r["pos"], r["lsn"], r["xid"], r["data"]


class LogStreamReader(SimpleDataSourceStreamReader):
    """Rows in the order of the log, at most so many in a batch: they pass through the driver, as a log has one reader."""

    def __init__(self, path: str, slot: str, most: int):
        self.transport, self.slot, self.most = FileTransport(path), slot, most

    def initialOffset(self) -> dict:  # noqa: N802
        return {"rows": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = self.transport.read(start["rows"], self.most)
        return iter([(self.slot, *r) for r in rows]), {"rows": start["rows"] + len(rows)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter([(self.slot, *r) for r in self.transport.read(start["rows"], end["rows"] - start["rows"])])

    def commit(self, end: dict) -> None:
        """What lies before ``end`` is in a sink. A file log keeps it; a server's slot would move on here."""


RELEASED = "slot string, txn long, pos long, lsn string, xid long, commit_lsn string, commit_csn long, record string"
_STATE = "held string, last_lsn string"


class Reassembly:
    """The rules by which records become released transactions, one record after the other.

    ``start`` is where an earlier run had come to: what was committed there or before is dropped. What this run itself
    has released does not count, as a transaction may be held back by one that is committed after it.
    """

    def __init__(self, snapshot_csn: int = -1, start: str | None = None, queue: list[dict] | None = None, last_lsn: str | None = None):
        self.snapshot_csn, self.start, self.queue, self.last_lsn = snapshot_csn, start, deque(queue or []), last_lsn or start
        self.open = {t["xid"]: t for t in self.queue if t["commit"] is None}

    def add(self, pos: int, lsn: str, xid: int, csn: int, type_: str, record: str) -> Iterator[tuple]:
        """Takes a record, and gives what it releases: (txn, pos, lsn, xid, commit_lsn, commit_csn, record)."""
        if type_ == "BEGIN":
            if xid not in self.open:
                self.open[xid] = {"xid": xid, "txn": pos, "commit": None, "csn": 0, "rows": []}
                self.queue.append(self.open[xid])
        elif type_ == "COMMIT":
            if (found := self.open.pop(xid, None)) is not None:
                found["commit"], found["csn"] = lsn, csn
            elif not self.queue:
                self._done(lsn)
        elif type_ in ("INSERT", "UPDATE", "DELETE"):
            found = self.open.get(xid)
            if found is None:
                found = {"xid": xid, "txn": pos, "commit": lsn, "csn": 0, "rows": []}
                self.queue.append(found)
            found["rows"].append([pos, lsn, record])
        while self.queue and self.queue[0]["commit"] is not None:
            t = self.queue.popleft()
            known = 0 <= self.snapshot_csn and 0 < t["csn"] <= self.snapshot_csn
            if not known and not _at_or_before(t["commit"], self.start):
                for at, row_lsn, row in t["rows"]:
                    yield t["txn"], at, row_lsn, t["xid"], t["commit"], t["csn"], row
            self._done(t["commit"])

    def _done(self, lsn: str) -> None:
        if not _at_or_before(lsn, self.last_lsn):
            self.last_lsn = lsn


def _at_or_before(lsn: str | None, other: str | None) -> bool:
    a, b = lsn_to_int(lsn), lsn_to_int(other)
    return a is not None and b is not None and a <= b


def reassemble_stream(changes: DataFrame, snapshot_csn: int = -1, last_lsn: str | None = None) -> DataFrame:
    """Released records of a streaming log of changes (slot, pos, lsn, xid, csn, type, and ``raw``, which comes out
    as ``record``). State is kept for each slot and holds open transactions only, as one value that each batch writes anew (2 GB
    at most); decoding before and formatting after it are spread over all tasks."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, last = state.get if state.exists else ("[]", last_lsn)
        work = Reassembly(snapshot_csn, last_lsn, json.loads(held), last)
        rows = pd.concat(frames).sort_values("pos")
        out = []
        for r in rows.itertuples(index=False):
            out += [(key[0], *x) for x in work.add(int(r.pos), r.lsn, int(r.xid), int(r.csn), r.type, r.raw)]
        state.update((json.dumps(list(work.queue)), work.last_lsn))
        yield pd.DataFrame(out, columns=["slot", "txn", "pos", "lsn", "xid", "commit_lsn", "commit_csn", "record"])

    slim = changes.select("slot", "pos", "lsn", "xid", "csn", "type", "raw")
    return slim.groupBy("slot").applyInPandasWithState(run, RELEASED, _STATE, "append", GroupStateTimeout.NoTimeout)
