"""SQL text and connection addresses."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote as percent


@dataclass(frozen=True)
class Dialect:
    """A database's SQL and addresses. Identifiers stay as they are unless a quote mark is given; compatible products
    are values of their own, or derive from it.

    ``drivers``: driver classes in the order in which they are tried, the product's own first. ``sibling_prefix``: the
    address prefix of a product whose addresses are taken too, if asked for.
    """

    name: str = "postgres-family"
    prefix: str = "jdbc:postgresql:"
    drivers: tuple[str, ...] = ("org.postgresql.Driver",)
    sibling_prefix: str | None = None
    mark: str = ""

    def quote_identifier(self, name: str) -> str:
        return f"{self.mark}{name.replace(self.mark, self.mark * 2)}{self.mark}" if self.mark else name

    def columns(self, names: list[str]) -> str:
        return ", ".join(map(self.quote_identifier, names))

    def limit_clause(self, n: int) -> str:
        return f"LIMIT {n}"

    def _where(self, keys: list[str], value: str) -> str:
        return " AND ".join(f"{self.quote_identifier(k)} = {value.format(k)}" for k in keys)

    def select(self, table: str, fields: list[str], keys: list[str] | None = None, value: str = ":{}") -> str:
        where = f" WHERE {self._where(keys, value)}" if keys else ""
        return f"SELECT {self.columns(fields)} FROM {self.quote_identifier(table)}{where}"

    def insert(self, table: str, fields: list[str], value: str = ":{}") -> str:
        values = ", ".join(value.format(f) for f in fields)
        return f"INSERT INTO {self.quote_identifier(table)}({self.columns(fields)}) VALUES ({values})"

    def update(self, table: str, fields: list[str], keys: list[str], value: str = ":{}") -> str:
        sets = ", ".join(f"{self.quote_identifier(f)} = {value.format(f)}" for f in fields if f not in keys)
        return f"UPDATE {self.quote_identifier(table)} SET {sets} WHERE {self._where(keys, value)}"

    def delete(self, table: str, keys: list[str], value: str = ":{}") -> str:
        return f"DELETE FROM {self.quote_identifier(table)} WHERE {self._where(keys, value)}"

    def row_exists(self, table: str, keys: list[str], value: str = ":{}") -> str:
        return f"SELECT 1 FROM {self.quote_identifier(table)} WHERE {self._where(keys, value)}"

    def upsert(self, table: str, fields: list[str], keys: list[str], value: str = ":{}", ignore_null: bool = False) -> str:
        """An insert that updates all other columns where the key is there already; nothing, if all columns are keys.
        With ``ignore_null`` a null that comes in leaves the stored value."""
        sets = []
        for f in (f for f in fields if f not in keys):
            q = self.quote_identifier(f)
            sets.append(f"{q}=COALESCE(VALUES({q}), {q})" if ignore_null else f"{q}=VALUES({q})")
        return f"{self.insert(table, fields, value)} ON DUPLICATE KEY UPDATE {', '.join(sets) or 'NOTHING'}"

    def merge(self, target: str, staged: str, fields: list[str], keys: list[str], ignore_null: bool = False) -> str:
        """The same from a staged table, in standard SQL."""
        on = " AND ".join(f"t.{self.quote_identifier(k)} = s.{self.quote_identifier(k)}" for k in keys)
        other = [self.quote_identifier(f) for f in fields if f not in keys]
        sets = ", ".join(f"{q} = COALESCE(s.{q}, t.{q})" if ignore_null else f"{q} = s.{q}" for q in other)
        values = ", ".join(f"s.{self.quote_identifier(f)}" for f in fields)
        matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
        return f"MERGE INTO {target} t USING {staged} s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({self.columns(fields)}) VALUES ({values})"

    def keyset_page(self, table: str, fields: list[str], keys: list[str], limit: int, first: bool = False) -> str:
        """A page of rows behind a cursor over ``keys``, of one or two columns; the first page has no tie-break."""
        q = [self.quote_identifier(k) for k in keys]
        if len(q) == 1:
            where = "" if first else f" WHERE {q[0]} > ?"
        else:
            where = f" WHERE {q[0]} > ?" if first else f" WHERE {q[0]} > ? OR ({q[0]} = ? AND {q[1]} > ?)"
        return f"SELECT {self.columns(fields)} FROM {table}{where} ORDER BY {', '.join(q)} {self.limit_clause(limit)}"

    def accepts_url(self, url: str | None, loadable: Callable[[str], bool] = lambda _: False) -> bool:
        """Whether an address is ours; a sibling product's only if that is configured and our own driver can be loaded."""
        if not url:
            return False
        return url.startswith(self.prefix) or bool(self.sibling_prefix) and url.startswith(self.sibling_prefix) and loadable(self.drivers[0])

    def default_driver(self, loadable: Callable[[str], bool]) -> str:
        """The first driver class that can be loaded, or the product's own."""
        return next((d for d in self.drivers if loadable(d)), self.drivers[0])

    def jdbc_url(self, host: str, port: int, database: str, sslmode: str = "prefer", connect_timeout_ms: int = 30_000) -> str:
        """The address for queries; the timeout in whole seconds, one at least."""
        return f"{self.prefix}//{host}:{port}/{database}?sslmode={sslmode}&connectTimeout={max(1, math.ceil(connect_timeout_ms / 1000))}"


#: Dialects by name; others are added with ``register``.
_DIALECTS: dict[str, Dialect] = {}


def register(dialect: Dialect) -> Dialect:
    _DIALECTS[dialect.name] = dialect
    return dialect


def dialect_for(url: str, loadable: Callable[[str], bool] = lambda _: False) -> Dialect:
    """The dialect registered last that takes the address."""
    for dialect in reversed(_DIALECTS.values()):
        if dialect.accepts_url(url, loadable):
            return dialect
    raise ValueError(f"no dialect takes the address {url.partition('?')[0]}")


POSTGRES_FAMILY = register(Dialect())


def replication_url(url: str, replication_port: int | None = None) -> str:
    """The address for the log: another port if there is one for it, and the parameters that a log connection needs."""
    url = url.rstrip("?&")
    if replication_port is not None:
        url = re.sub(r"(//[^/:?]+):\d+", rf"\g<1>:{replication_port}", url, count=1)
    for name, value in (("replication", "database"), ("preferQueryMode", "simple"), ("assumeMinServerVersion", "9.4")):
        if not re.search(rf"[?&]{name}=", url):
            url += f"{'&' if '?' in url else '?'}{name}={value}"
    return url


def slot_options(parallel: int = 1, style: str = "b", batch: bool = False) -> dict[str, str]:
    """The options of a log slot."""
    options = {"include-xids": "1", "include-timestamp": "1"}
    if parallel > 1:
        options |= {"parallel-decode-num": str(parallel), "decode-style": style.lower()}
        if batch:
            options["sending-batch"] = "1"
    return options


def peek_sql(limit: int, parallel: int = 1) -> str:
    """Reads a slot without moving it."""
    extra = f", 'parallel-decode-num', '{parallel}'" if parallel > 1 else ""
    return f"SELECT * FROM pg_logical_slot_peek_changes(?, NULL, {limit}, 'include-xids', '1'{extra})"


def snapshot_id(text: str) -> str:
    """A snapshot's name, checked before it goes into SQL."""
    if not re.fullmatch(r"[0-9A-Fa-f-]+", text):
        raise ValueError(f"not a snapshot id: {text!r}")
    return text


def snapshot_boundary(group: int, snapshot: str, csn: int) -> str:
    """What one reader tells the others about the common snapshot, in its connection's name."""
    return f"snapshot_{group & 0xFFFFFFFF}:{percent(snapshot_id(snapshot))}:{csn:X}"


def parse_boundary(text: str) -> tuple[str, int]:
    head, _, csn = text.rpartition(":")
    return snapshot_id(head.partition(":")[2]), int(csn, 16)


def function_exists(name: str) -> str:
    """Whether the server has a function, whatever schema it lies in."""
    text = name.replace("'", "''")
    return f"SELECT EXISTS (SELECT 1 FROM pg_proc p JOIN pg_namespace n ON n.oid = p.pronamespace WHERE p.proname = '{text}')"


#: How a snapshot is exported, the best way first: with its sequence number at once, or the number before it, or without one.
SNAPSHOT_EXPORTS = (
    ("pg_export_snapshot_and_csn", "SELECT * FROM pg_export_snapshot_and_csn()"),
    ("pg_current_csn", "SELECT pg_export_snapshot(), pg_current_csn()"),
    ("pg_export_snapshot", "SELECT pg_export_snapshot(), NULL"),
)


def import_snapshot(snapshot: str) -> list[str]:
    """Takes another connection's snapshot, in a transaction that has read nothing yet."""
    return ["BEGIN TRANSACTION ISOLATION LEVEL REPEATABLE READ", f"SET TRANSACTION SNAPSHOT '{snapshot_id(snapshot)}'"]


def advisory_lock(group: int, locked: bool = True) -> str:
    """Takes or gives back the lock that one of several readers holds while it exports a snapshot."""
    return f"SELECT pg_{'try_' if locked else ''}advisory_{'lock' if locked else 'unlock'}({int(group)})"
