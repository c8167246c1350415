"""Log records in text form: what they are, and what they hold, as column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import split_qualified
from .types import type_oid

COLUMN = "struct<name:string,type_oid:int,value:string>"
WAL_CHANGE = (
    "slot string, pos long, lsn string, xid long, csn long, type string, schema string, `table` string, "
    f"before array<{COLUMN}>, after array<{COLUMN}>, raw string"
)

_JSON = (
    "table_name string, op_type string, columns_name array<string>, columns_type array<string>, columns_val array<string>, "
    "old_keys_name array<string>, old_keys_type array<string>, old_keys_val array<string>"
)
_DATA = ("INSERT", "UPDATE", "DELETE")


def record_kind(data: Column) -> Column:
    """BEGIN, COMMIT, INSERT, UPDATE, DELETE or UNKNOWN."""
    parsed = F.upper(F.get_json_object(data, "$.op_type"))
    kind = F.when(data.startswith("BEGIN"), "BEGIN").when(data.startswith("COMMIT"), "COMMIT")
    kind = kind.when(F.ltrim(data).startswith("{"), F.when(parsed.isin(*_DATA), parsed).otherwise("UNKNOWN"))
    for name in _DATA:
        kind = kind.when(data.contains(name), name)
    return kind.otherwise("UNKNOWN")


def commit_csn(data: Column) -> Column:
    """The sequence number of a COMMIT record, 0 if it has none that is a number."""
    return F.coalesce(F.regexp_extract(data, r"CSN (\S+)", 1).try_cast("long"), F.lit(0).cast("long"))


def unquoted(value: Column) -> Column:
    """A value's text without its quotes, and with doubled quotes in it single; a bare null is null."""
    inner = F.regexp_replace(F.regexp_extract(value, "(?s)^'(.*)'$", 1), "''", "'")
    return F.when(value.rlike("(?s)^'.*'$"), inner).when(F.lower(F.trim(value)) == "null", F.lit(None).cast("string")).otherwise(value)


def zipped(names: Column, types: Column, values: Column) -> Column:
    """Names, type names and values as a list of columns; a missing type is text, a missing value is null."""
    one = lambda name, k: F.struct(
        name.alias("name"), type_oid(F.get(types, k)).alias("type_oid"), unquoted(F.get(values, k)).alias("value")
    )
    return F.when(F.size(names) > 0, F.transform(names, one))


def parse_records(log: DataFrame, data: str = "data", keep: list[str] | None = None) -> DataFrame:
    """A log (slot, pos, lsn, xid, data, and ``k`` where batches were split) as changes; ``keep`` names other columns to
    stand before them. Fields that a record does not have are null.

    A JSON object that is no record, and anything else that is none, has the type UNKNOWN and is kept with its text.
    """
    raw = F.col(data)
    rows = log.withColumn("_type", record_kind(raw)).withColumn("_json", F.from_json(F.when(F.ltrim(raw).startswith("{"), raw), _JSON))
    is_json, is_data = F.ltrim(raw).startswith("{"), F.col("_type").isin(*_DATA)
    text_name = F.regexp_extract(raw, r"(?:INSERT|UPDATE|DELETE):?\s+([^\s\[]+)", 1)
    name = split_qualified(F.when(is_data, F.when(is_json, F.col("_json.table_name")).otherwise(F.nullif(text_name, F.lit("")))))
    new = zipped(F.col("_json.columns_name"), F.col("_json.columns_type"), F.col("_json.columns_val"))
    old = zipped(F.col("_json.old_keys_name"), F.col("_json.old_keys_type"), F.col("_json.old_keys_val"))
    place = keep or ["slot", "pos", *(["k"] if "k" in log.columns else []), "lsn", "xid"]
    return rows.select(
        *place,
        F.when(F.col("_type") == "COMMIT", commit_csn(raw)).otherwise(F.lit(0).cast("long")).alias("csn"),
        F.col("_type").alias("type"),
        name["schema"].alias("schema"), name["table"].alias("table"),
        F.when(F.col("_type").isin("UPDATE", "DELETE"), old).alias("before"),
        F.when(F.col("_type").isin("INSERT", "UPDATE"), new).alias("after"),
        raw.alias("raw"),
    )


#: What counts within an object: a string, up to the text's end if nothing closes it, or a brace.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}]', re.DOTALL)


def split_objects(text: str) -> Iterator[str]:
    """The whole JSON objects of a batch, one after the other, whatever stands between them; an unclosed one ends it."""
    start = text.find("{")
    while start >= 0:
        depth, end = 0, -1
        for token in _TOKEN.finditer(text, start):
            c = text[token.start()]
            depth += (c == "{") - (c == "}")
            if depth == 0:
                end = token.end()
                break
        if end < 0:
            return
        yield text[start:end]
        start = text.find("{", end)


def split_batches(log: DataFrame, data: str = "data") -> DataFrame:
    """One row for each JSON object of each batch; ``k`` is its place in the batch, so (pos, k) is its place in the log.

    Batches that hold no object stay as they are, so that markers pass through.
    """
    others = [c for c in log.columns if c not in (data, "pos")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, objects, places = [], [], []
            for row, text in enumerate(batch.column("data").to_pylist()):
                for k, one in enumerate(list(split_objects(text or "")) or [text]):
                    at.append(row)
                    objects.append(one)
                    places.append(k)
            kept = batch.select([*others, "pos"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(places, pa.int32()), pa.array(objects, pa.string())], names=[*others, "pos", "k", "data"])

    rows = log.select(*others, F.col("pos").cast("long"), F.col(data).alias("data"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name in others)
    return rows.mapInArrow(run, f"{fields}pos long, k int, data string")


def json_record(table: str, op: str, new: list[tuple[str, str, str | None]], old: list[tuple[str, str, str | None]] = ()) -> str:
    """A record's JSON text, as a server writes it: for tests and replays. Columns are (name, type, value)."""
    quote = lambda kind, v: "null" if v is None else v if kind in _BARE else "'" + v.replace("'", "''") + "'"
    part = lambda key, cols: {f"{key}_name": [c[0] for c in cols], f"{key}_type": [c[1] for c in cols], f"{key}_val": [quote(c[1], c[2]) for c in cols]}
    return json.dumps({"table_name": table, "op_type": op} | part("columns", new) | part("old_keys", old), ensure_ascii=False)


_BARE = {"integer", "bigint", "smallint", "numeric", "real", "double precision", "boolean"}
