"""Changelogs and tables: a table from its changes, changes from two states of a table, and polling with cursors."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Change codes: created, updated, deleted, read in a snapshot.
CREATED, UPDATED, DELETED, READ = "c", "u", "d", "r"


def latest(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. One aggregation with partial results before the shuffle: no sort, and a hot key costs a
    row for each task, not one for each change."""
    others = [c for c in changes.columns if c not in keys]
    place = F.struct(*order)
    row = changes.groupBy(*keys).agg(F.max_by(F.struct(*others), place).alias("_row"))
    return row.select(*keys, *(F.col("_row")[c].alias(c) for c in others)).select(changes.columns)


def materialise(changes: DataFrame, keys: list[str], order: list[str], op: str = "_op") -> DataFrame:
    """The current table: the last image of each key, without deleted ones and without the change code."""
    return latest(changes, keys, order).filter(F.col(op) != DELETED).drop(op, *(c for c in order if c.startswith("_")))


def apply_changes(table: DataFrame, changes: DataFrame, keys: list[str], order: list[str], op: str = "_op") -> DataFrame:
    """``table`` after ``changes``. The changes are reduced to the last one of each key before they meet the table."""
    last = latest(changes, keys, order)
    kept = table.join(last.select(*keys), keys, "left_anti")
    return kept.unionByName(last.filter(F.col(op) != DELETED).select(table.columns))


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], ignore_null: bool = False) -> DataFrame:
    """``table`` with the rows of ``rows`` (one for each key) in place of its own; with ``ignore_null`` a null that comes in
    leaves the stored value."""
    others = [c for c in table.columns if c not in keys]
    new = rows.select(*keys, F.struct(*others).alias("_new"))
    joined = table.select(*keys, F.struct(*others).alias("_old")).join(new, keys, "full")
    value = lambda c: F.coalesce(F.col("_new")[c], F.col("_old")[c]) if ignore_null else F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col("_old")[c])
    return joined.select(*(F.col(c) if c in keys else value(c).alias(c) for c in table.columns))


def delete_by_key(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(gone.select(*keys).distinct(), keys, "left_anti")


def aligned(columns: Column, names: list[str], types: dict[str, T.DataType] | None = None) -> list[Column]:
    """A sparse list of (name, type_oid, value) as all columns of a table, by name; absent ones are null."""
    from ..functions.types import cast_value

    by_name = F.map_from_entries(F.transform(columns, lambda c: F.struct(c["name"], c["value"])))
    types = types or {}
    return [cast_value(F.try_element_at(by_name, F.lit(n)), types.get(n, T.StringType())).alias(n) for n in names]


def typed_rows(changes: DataFrame, schema: T.StructType, mode: str = "permissive", keep: list[str] = ()) -> DataFrame:
    """Changes as typed rows with ``_op``: the new image, or the old one of a delete; a change without its image is dropped.

    ``permissive`` adds ``_error``, the names of columns whose text is no value of their type (null there); rows with
    errors can then go elsewhere. ``drop`` leaves them out, ``failfast`` raises when such a row is read.
    """
    from ..functions.types import convertible

    image = F.when(F.col("type") == "DELETE", F.col("before")).otherwise(F.col("after"))
    op = F.when(F.col("type") == "INSERT", CREATED).when(F.col("type") == "UPDATE", UPDATED).when(F.col("type") == "DELETE", DELETED)
    names = [f.name for f in schema]
    rows = changes.select(*keep, op.alias("_op"), image.alias("_image")).filter("_op is not null and size(_image) > 0")
    text = aligned(F.col("_image"), names)
    bad = F.filter(F.array(*(F.when(~convertible(t, f.dataType), F.lit(f.name)) for t, f in zip(text, schema, strict=True))), lambda n: n.isNotNull())
    out = rows.select(*keep, "_op", *aligned(F.col("_image"), names, {f.name: f.dataType for f in schema}), bad.alias("_error"))
    if mode == "permissive":
        return out
    if mode == "drop":
        return out.filter(F.size("_error") == 0).drop("_error")
    if mode != "failfast":
        raise ValueError(f"mode must be permissive, drop or failfast, not {mode}")
    checked = F.when(F.size("_error") == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no value of its type in: "), F.array_join("_error", ", "))).cast("boolean"))
    return out.filter(checked).drop("_error")


def diff_snapshots(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Changes that lead from one state to the other: ``_op``, the keys, and ``before`` and ``after`` as structs. It sees
    every change, with or without a column of change times."""
    others = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*others).alias("before"))
    new = after.select(*keys, F.struct(*others).alias("after"))
    op = F.when(F.col("before").isNull(), CREATED).when(F.col("after").isNull(), DELETED).when(~F.col("before").eqNullSafe(F.col("after")), UPDATED)
    return old.join(new, keys, "full").select(op.alias("_op"), *keys, "before", "after").filter("_op is not null")


@dataclass(frozen=True)
class Cursor:
    """Where a table's polling stands: the last key that was inserted, and the last (change time, key) that was updated."""

    last_key: Any = None
    last_time: Any = None
    last_update_key: Any = None


def initial_cursor(table: DataFrame, key: str, time: str | None = None) -> Cursor:
    """The cursor behind all rows of a snapshot. Null keys are an error."""
    place = F.struct(time, key) if time else F.struct(F.lit(None).cast("timestamp_ntz").alias("t"), F.col(key))
    seen = F.when(F.col(time).isNotNull(), place) if time else place
    last, top, nulls = table.agg(F.max(key), F.max(seen), F.count(F.when(F.col(key).isNull(), 1))).first()
    if nulls:
        raise ValueError(f"{nulls} rows have no {key}")
    return Cursor(last, top[0] if time and top else None, top[1] if time and top else None)


def insert_page(current: DataFrame, key: str, cursor: Cursor, size: int) -> DataFrame:
    """The next rows by key."""
    rows = current if cursor.last_key is None else current.filter(F.col(key) > F.lit(cursor.last_key))
    return rows.orderBy(key).limit(size)


def update_page(current: DataFrame, key: str, time: str, cursor: Cursor, size: int, epoch: str = "1970-01-01 00:00:00") -> DataFrame:
    """The next rows by (change time, key); before the first page there is no key to break a tie."""
    start = F.lit(epoch).cast("timestamp_ntz") if cursor.last_time is None else F.lit(cursor.last_time)
    later = F.col(time) > start
    if cursor.last_update_key is not None:
        later = later | ((F.col(time) == start) & (F.col(key) > F.lit(cursor.last_update_key)))
    return current.filter(later).orderBy(time, key).limit(size)


def classify(page: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a page against the rows known before: an update with its old image, or new."""
    others = [c for c in page.columns if c not in keys]
    old = known.select(*keys, F.struct(*others).alias("before"))
    new = page.select(*keys, F.struct(*others).alias("after")).join(old, keys, "left")
    return new.select(F.when(F.col("before").isNotNull(), UPDATED).otherwise(CREATED).alias("_op"), *keys, "before", "after")


def only_new(page: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a page whose key isn't known, as changes."""
    others = [c for c in page.columns if c not in keys]
    fresh = page.join(known.select(*keys), keys, "left_anti")
    image = F.struct(*others)
    return fresh.select(F.lit(CREATED).alias("_op"), *keys, F.when(F.lit(False), image).alias("before"), image.alias("after"))


def missing(known: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Known rows whose key is gone, as changes with their last image."""
    others = [c for c in known.columns if c not in keys]
    gone = known.join(current.select(*keys), keys, "left_anti")
    image = F.struct(*others)
    return gone.select(F.lit(DELETED).alias("_op"), *keys, image.alias("before"), F.when(F.lit(False), image).alias("after"))


def poll_cycle(known: DataFrame, current: DataFrame, key: str, cursor: Cursor, size: int = 1000, time: str | None = None) -> DataFrame:
    """One cycle: updates (if there is a column of change times), then inserts, then deletes, told apart by ``_phase``
    1, 2, 3; rows that the updates have found are known to the inserts, and both to the deletes."""
    if size <= 0:
        raise ValueError("a page must have at least one row")
    columns = known.columns
    phases, seen = [], known
    if time is not None:
        page = update_page(current, key, time, cursor, size).select(columns)
        phases.append(classify(page, known, [key]).withColumn("_phase", F.lit(1)))
        seen = upsert(seen, page, [key])
    page = insert_page(current, key, cursor, size).select(columns)
    phases.append(only_new(page, seen, [key]).withColumn("_phase", F.lit(2)))
    phases.append(missing(upsert(seen, page, [key]), current, [key]).withColumn("_phase", F.lit(3)))
    out = phases[0]
    for more in phases[1:]:
        out = out.unionByName(more)
    return out


def known_after(known: DataFrame, current: DataFrame, key: str, cursor: Cursor, size: int = 1000, time: str | None = None) -> DataFrame:
    """The rows known after one cycle: the pages take the place of older rows, and what is gone is forgotten."""
    seen = known
    if time is not None:
        seen = upsert(seen, update_page(current, key, time, cursor, size).select(known.columns), [key])
    seen = upsert(seen, insert_page(current, key, cursor, size).select(known.columns), [key])
    return seen.join(current.select(key), key, "left_semi").select(known.columns)


def next_cursor(current: DataFrame, key: str, cursor: Cursor, size: int = 1000, time: str | None = None) -> Cursor:
    """The cursor behind the pages of one cycle."""
    last = insert_page(current, key, cursor, size).agg(F.max(key)).first()[0]
    moved = cursor if last is None else replace(cursor, last_key=last)
    if time is not None:
        top = update_page(current, key, time, cursor, size).agg(F.max(F.struct(time, key))).first()[0]
        moved = moved if top is None else replace(moved, last_time=top[0], last_update_key=top[1])
    return moved
