"""Change events as JSON text, in three forms. All values are JSON strings, null stays null, and keys keep their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CONTROL = {chr(c): f"\\u{c:04x}" for c in range(32)} | {"\n": "\\n", "\r": "\\r", "\t": "\\t"}


def json_escape(text: Column) -> Column:
    """Text between the quotes of a JSON string: the quote, the backslash, line feed, carriage return and tab by their
    short forms, other control characters by lower-case numbers, all else as it is; null is empty."""
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    rare = out
    for c, escaped in _CONTROL.items():
        rare = F.replace(rare, F.lit(c), F.lit(escaped))
    return F.when(out.rlike("[\\x00-\\x1f]"), rare).otherwise(out)


def json_string(text: Column) -> Column:
    return F.when(text.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), json_escape(text), F.lit('"')))


def json_object(columns: Column) -> Column:
    """A list of (name, type_oid, value) as an object, in its order; ``{}`` for null and for an empty list."""
    pairs = F.transform(columns, lambda c: F.concat(F.lit('"'), json_escape(c["name"]), F.lit('":'), json_string(c["value"])))
    return F.when(columns.isNull(), F.lit("{}")).otherwise(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def image(names: list[str], prefix: str = "") -> Column:
    """Plain columns as a list of (name, type_oid, value), with values as text."""
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit(25).alias("type_oid"), F.col(prefix + n).cast("string").alias("value")) for n in names))


def _or_null(columns: Column, empty_object: bool) -> Column:
    missing = F.lit("{}") if empty_object else F.lit("null")
    return F.when(F.coalesce(F.size(columns), F.lit(0)) <= 0, missing).otherwise(json_object(columns))


def _text(value: Column | str | None) -> Column:
    return json_string(F.lit(None).cast("string")) if value is None else json_string(F.lit(value) if isinstance(value, str) else value)


def _list(values: list[Column]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *map(json_string, values)), F.lit("]"))


def _object(*parts: tuple[str, Column]) -> Column:
    out: list[Column] = []
    for k, (key, value) in enumerate(parts):
        out += [F.lit(f'{"," if k else "{"}"{key}":'), value]
    return F.concat(*out, F.lit("}"))


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def debezium(
    op: Column, before: Column, after: Column, database: str, schema: Column | str, table: Column | str, ts_ms: Column, lsn: Column | None = None,
    snapshot: bool = False, connector: str = "tidewire", empty_object: bool = False,
) -> Column:
    """before, after, source, op, ts_ms, transaction. ``op`` is c, u or d; snapshot rows are c with an empty before.

    An image that is missing is null; with ``empty_object`` the log's inserts and deletes have ``{}`` there instead.
    """
    ms = ts_ms.cast("string")
    source = [("connector", _text(connector)), ("db", _text(database)), ("schema", _text(schema)), ("table", _text(table))]
    source += [("lsn", _text(lsn))] if lsn is not None else []
    return _object(
        ("before", F.lit("null") if snapshot else _or_null(before, empty_object)),
        ("after", _or_null(after, empty_object)),
        ("source", _object(*source, ("ts_ms", ms), ("snapshot", F.lit("true" if snapshot else "false")))),
        ("op", F.lit('"c"') if snapshot else json_string(op)),
        ("ts_ms", ms),
        ("transaction", F.lit("null")),
    )


_NAMES = ("INSERT", "UPDATE", "DELETE")


def type_name(op: Column) -> Column:
    """INSERT, UPDATE or DELETE for c (and r), u, d."""
    return F.when(op.isin("c", "r"), "INSERT").when(op == "u", "UPDATE").when(op == "d", "DELETE")


def canal(op: Column, before: Column, after: Column, database: str, table: Column | str, keys: list[str], ts_ms: Column) -> Column:
    """data, old, database, table, type, pkNames, es, ts, isDdl, sqlType, mysqlType. ``data`` is null for a delete, ``old``
    for an insert and where there is no old image."""
    ms = ts_ms.cast("string")
    return _object(
        ("data", F.when(op == "d", F.lit("null")).otherwise(_or_null(after, False))),
        ("old", F.when(op.isin("c", "r"), F.lit("null")).otherwise(_or_null(before, False))),
        ("database", _text(database)),
        ("table", _text(table)),
        ("type", json_string(type_name(op))),
        ("pkNames", _list([F.lit(k) for k in keys])),
        ("es", ms),
        ("ts", ms),
        ("isDdl", F.lit("false")),
        ("sqlType", F.lit("{}")),
        ("mysqlType", F.lit("{}")),
    )


def value_of(columns: Column, name: str) -> Column:
    """The value of a name in a list of (name, type_oid, value)."""
    return F.get(F.filter(columns, lambda c: c["name"] == name), F.lit(0))["value"]


def key_values(op: Column, before: Column, after: Column, keys: list[str]) -> list[Column]:
    """The keys' values: of the new image, or of the old one for a delete."""
    whole = F.when(op == "d", before).otherwise(after)
    return [value_of(whole, k) for k in keys]


def he(op: Column, before: Column, after: Column, database: str, table: Column | str, keys: list[str], ts_ms: Column, lsn: Column | None = None) -> Column:
    """database, table, optType, pkNames, pkValues, es, ts, data, old, and lsn for records of a log."""
    ms = ts_ms.cast("string")
    parts = [
        ("database", _text(database)),
        ("table", _text(table)),
        ("optType", json_string(type_name(op))),
        ("pkNames", _list([F.lit(k) for k in keys])),
        ("pkValues", _list(key_values(op, before, after, keys))),
        ("es", ms),
        ("ts", ms),
        ("data", F.when(op == "d", F.lit("null")).otherwise(_or_null(after, False))),
        ("old", F.when(op.isin("c", "r"), F.lit("null")).otherwise(_or_null(before, False))),
    ]
    return _object(*parts, *([("lsn", _text(lsn))] if lsn is not None else []))
