"""The binary form of log records: decoding and encoding, and decoding over a DataFrame.

A batch is a run of records, big-endian: a 32-bit size (of what follows it; 0 ends the batch), the 64-bit position,
a type byte and a body. After a record stands P, or F behind the last one; the size may or may not count it.
Bodies: B csn, first position, then optional T (length, time) and N (length, user); C optional X xid, T time; I, U, D
schema and table (16-bit lengths) and tuples, each marked N (new) or O (old). A tuple has a 16-bit number of columns,
and for each its name (16-bit length), type and value (32-bit length, FFFFFFFF for null).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import written
from .lsn import lsn_number
from .records import COLUMN

Value = tuple[str, int, str | None]
_NULL = 0xFFFFFFFF
# Record types.
_TYPES = {"B": "BEGIN", "C": "COMMIT", "I": "INSERT", "U": "UPDATE", "D": "DELETE"}
_LETTERS = {v: k for k, v in _TYPES.items()}


class DecodeError(ValueError):
    """A record that can't be read."""


@dataclass
class WalChange:
    type: str
    position: int
    xid: int = 0
    csn: int = 0
    schema: str | None = None
    table: str | None = None
    before: list[Value] | None = None
    after: list[Value] | None = None
    error: str | None = field(default=None, compare=False)

    @property
    def lsn(self) -> str:
        return f"{self.position >> 32:X}/{self.position & 0xFFFFFFFF:X}"


_HEAD, _TUPLE, _BEGIN, _LONG, _INT, _SHORT = (struct.Struct(f) for f in (">QB", ">II", ">QQ", ">Q", ">I", ">H"))


def _some(data: bytes, at: int, n: int) -> bytes:
    if at + n > len(data):
        raise DecodeError(f"{n} bytes wanted, {len(data) - at} left")
    return data[at : at + n]


def _name(data: bytes, at: int) -> tuple[str, int]:
    """A text with a length of 16 bits, and where it ends."""
    n = _SHORT.unpack_from(data, at)[0]
    return _some(data, at + 2, n).decode("utf-8"), at + 2 + n


def _tuple(data: bytes, at: int) -> tuple[list[Value], int]:
    n, out = _SHORT.unpack_from(data, at)[0], []
    at += 2
    for _ in range(n):
        name, at = _name(data, at)
        kind, size = _TUPLE.unpack_from(data, at)
        at += 8
        if size == _NULL:
            out.append((name, kind, None))
        else:
            out.append((name, kind, _some(data, at, size).decode("utf-8")))
            at += size
    return out, at


def _after_long_text(data: bytes, at: int, letter: bytes) -> int:
    """Behind an optional text that ``letter`` marks."""
    if data[at : at + 1] != letter:
        return at
    n = _INT.unpack_from(data, at + 1)[0]
    _some(data, at + 5, n)
    return at + 5 + n


def _body(kind: str, position: int, data: bytes) -> tuple[WalChange, int]:
    """A record from its bytes, the position and the type letter before it included, and where it ends."""
    change, at = WalChange(kind, position), _HEAD.size
    if kind == "BEGIN":
        change.csn = _BEGIN.unpack_from(data, at)[0]
        at = _after_long_text(data, _after_long_text(data, at + 16, b"T"), b"N")
    elif kind == "COMMIT":
        if data[at : at + 1] == b"X":
            change.xid = _LONG.unpack_from(data, at + 1)[0]
            at += 9
        at = _after_long_text(data, at, b"T")
    else:
        change.schema, at = _name(data, at)
        change.table, at = _name(data, at)
        while len(data) - at > 1:
            mark = data[at : at + 1]
            row, at = _tuple(data, at + (mark in (b"O", b"N")))
            if mark == b"O" or mark != b"N" and kind == "DELETE":
                change.before = row
            else:
                change.after = row
        if kind == "DELETE" and change.before is None:
            change.before, change.after = change.after, None
    return change, at


def decode_batch(data: bytes) -> list[WalChange]:
    """The records of a batch. One that can't be read is UNKNOWN, with ``error``; the next one starts behind its size."""
    at, out = 0, []
    while len(data) - at >= 4:
        size = _INT.unpack_from(data, at)[0]
        at += 4
        if size == 0:
            break
        if size > len(data) - at or size < 9:
            out.append(WalChange("UNKNOWN", 0, error=f"size {size}, {len(data) - at} bytes left"))
            break
        record = data[at : at + size]
        at += size
        position, letter = _HEAD.unpack_from(record)
        end = b""
        if chr(letter) in _TYPES:
            try:
                change, stop = _body(_TYPES[chr(letter)], position, record)
                end = record[stop:]
            except (DecodeError, UnicodeDecodeError, struct.error) as error:
                change = WalChange("UNKNOWN", position, error=str(error))
        else:
            change = WalChange("UNKNOWN", position, error=f"type {chr(letter)!r}")
        out.append(change)
        if end not in (b"P", b"F"):
            end = data[at : at + 1]
            at += end in (b"P", b"F")
        if end == b"F":
            break
    return out


def _text(value: str, size: int) -> bytes:
    raw = value.encode()
    return len(raw).to_bytes(size, "big") + raw


def _row(values: list[Value]) -> bytes:
    out = struct.pack(">H", len(values))
    for name, kind, value in values:
        out += _text(name, 2) + struct.pack(">I", kind) + (struct.pack(">I", _NULL) if value is None else _text(value, 4))
    return out


def encode_batch(changes: list[WalChange], separator_inside: bool = False) -> bytes:
    """A batch, for tests and replays."""
    out = b""
    for k, c in enumerate(changes):
        if c.type == "BEGIN":
            body = struct.pack(">QQ", c.csn, c.position)
        elif c.type == "COMMIT":
            body = b"X" + struct.pack(">Q", c.xid) if c.xid else b""
        else:
            body = _text(c.schema or "", 2) + _text(c.table or "", 2)
            body += b"".join(m + _row(v) for m, v in ((b"N", c.after), (b"O", c.before)) if v is not None)
        record = struct.pack(">Q", c.position) + _LETTERS[c.type].encode() + body
        mark = b"F" if k == len(changes) - 1 else b"P"
        out += struct.pack(">I", len(record) + separator_inside) + record + mark
    return out


_ARROW_VALUE = pa.struct([("name", pa.string()), ("type_oid", pa.int32()), ("value", pa.string())])
_ARROW = {"pos": pa.int64(), "k": pa.int32(), "lsn": pa.string(), "xid": pa.int64(), "csn": pa.int64(), "type": pa.string(), "schema": pa.string(), "table": pa.string(), "raw": pa.string()}
DECODED = f"slot string, pos long, k int, lsn string, xid long, csn long, type string, schema string, `table` string, before array<{COLUMN}>, after array<{COLUMN}>, raw string"


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _images(rows: list[list[Value] | None]) -> pa.Array:
    flat = [v for row in rows if row for v in row]
    ends = np.cumsum([0, *(len(row or ()) for row in rows)])
    fields = [pa.array([v[i] for v in flat], f.type) for i, f in enumerate(_ARROW_VALUE)]
    offsets = pa.array(ends.astype(np.int32), mask=np.array([*(row is None for row in rows), False]))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(_ARROW_VALUE)))


def decode_binary(log: DataFrame) -> DataFrame:
    """Binary batches (slot, pos, data) as changes. Batches are decoded where they lie, in parallel; ``k`` is a record's
    place in its batch, so (pos, k) is its place in the log. ``raw`` says why a record is UNKNOWN.

    Records carry no transaction number but in COMMIT, and transactions lie one after the other. Here the xid of a record is
    the position of its transaction's BEGIN, and a COMMIT has the csn of that BEGIN; a record outside of any
    transaction has its own position. What stands in a batch before its first BEGIN or COMMIT has a null xid: the batches
    before tell whose it is, see ``number_transactions``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, before, after, out = [], [], [], {name: [] for name in _ARROW}
            for row, (pos, data) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), strict=True)):
                told, opened, csn = False, None, None
                for k, c in enumerate(decode_batch(data.as_py() or b"")):
                    own = _signed(c.position)
                    if c.type == "BEGIN":
                        told, opened, csn = True, own, c.csn
                    xid = opened if opened is not None else own if told else None
                    commit_csn = csn if opened is not None or not told else 0
                    at.append(row)
                    values = (pos, k, c.lsn, xid, _signed(commit_csn if c.type == "COMMIT" and commit_csn is not None else c.csn), c.type, c.schema, c.table, c.error)
                    for name, value in zip(_ARROW, values, strict=True):
                        out[name].append(value)
                    before.append(c.before)
                    after.append(c.after)
                    if c.type == "COMMIT":
                        told, opened = True, None
            cols = {name: pa.array(out[name], kind) for name, kind in _ARROW.items()} | {"slot": batch.column(0).take(pa.array(at, pa.int64())), "before": _images(before), "after": _images(after)}
            names = ["slot", "pos", "k", "lsn", "xid", "csn", "type", "schema", "table", "before", "after", "raw"]
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return log.select("slot", F.col("pos").cast("long").alias("pos"), F.col("data").cast("binary").alias("data")).mapInArrow(run, DECODED)


def number_transactions(changes: DataFrame) -> DataFrame:
    """Binary changes with the xid of every record's transaction. They are written once; a window goes over a row for each
    batch that has a BEGIN or COMMIT, or begins inside a transaction, and tells what the batches before it left open."""
    rows = written(changes, "decoded")
    if rows.filter("xid is null").isEmpty():  # every batch begins outside of any transaction
        return rows
    markers = rows.filter(F.col("type").isin("BEGIN", "COMMIT"))
    ends = markers.groupBy("slot", "pos").agg(F.max_by(F.struct("type", "xid", "csn"), "k").alias("end")).withColumn("asks", F.lit(False))
    asks = rows.filter("xid is null").select("slot", "pos").distinct().select("slot", "pos", F.lit(None).cast(ends.schema["end"].dataType).alias("end"), F.lit(True).alias("asks"))
    order = Window.partitionBy("slot").orderBy("pos", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    told = ends.unionByName(asks).withColumn("_left", F.last("end", ignorenulls=True).over(order)).filter("asks and _left.type = 'BEGIN'")
    told = told.select("slot", "pos", F.col("_left.xid").alias("_xid"), F.col("_left.csn").alias("_csn"))
    asking = rows.filter("xid is null").join(told, ["slot", "pos"], "left")
    position = lsn_number(F.col("lsn"))
    own = F.when(position >= F.lit(Decimal(1 << 63)), position - F.lit(Decimal(1 << 64))).otherwise(position).try_cast("long")
    csn = F.when((F.col("type") == "COMMIT") & F.col("_csn").isNotNull(), F.col("_csn")).otherwise(F.col("csn"))
    filled = asking.withColumn("xid", F.coalesce("_xid", own)).withColumn("csn", csn).select(rows.columns)
    return rows.filter("xid is not null").unionByName(filled)
