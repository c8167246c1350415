"""Options of the connectors: names, defaults, and what they may be."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field, fields
from typing import Any

# Option names as users write them, where they are not the field's name with dashes.
_NAMES = {
    "replication_port": "replication.port",
    "output_format": "output.format",
    "json_format": "output.json.format",
    "slot_name": "slot.name",
    "plugin_name": "plugin.name",
    "snapshot_mode": "snapshot.mode",
    "chunk_size": "chunk.size",
    "connect_timeout_ms": "connect.timeout.ms",
    "poll_interval_ms": "poll.interval.ms",
    "decode_plugin": "decode.plugin",
    "wal_mode": "wal.mode",
    "buffer_rows": "sink.buffer-flush.max-rows",
    "buffer_interval_ms": "sink.buffer-flush.interval",
    "max_retries": "sink.max-retries",
    "parallelism": "sink.parallelism",
    "ignore_null": "sink.ignore-null-when-update",
    "partition_column": "scan.partition.column",
    "partition_num": "scan.partition.num",
    "lower_bound": "scan.partition.lower-bound",
    "upper_bound": "scan.partition.upper-bound",
    "fetch_size": "scan.fetch-size",
    "auto_commit": "scan.auto-commit",
    "connection_timeout_s": "connection.max-retry-timeout",
}


class OptionError(ValueError):
    """An option that is missing, unknown or out of bounds."""


def named_function(text: str) -> Callable:
    """A function named as ``module:function``."""
    module, _, name = text.partition(":")
    if not name:
        raise OptionError(f"a function is named as module:function, not {text!r}")
    return getattr(importlib.import_module(module), name)


def _from(cls: type, options: dict[str, Any]) -> Any:
    by_name = {_NAMES.get(f.name, f.name.replace("_", "-")).lower(): f for f in fields(cls)}
    given = {k.lower(): v for k, v in options.items()}
    if unknown := sorted(set(given) - set(by_name)):
        raise OptionError(f"unknown options: {', '.join(unknown)}")
    values = {}
    for name, value in given.items():
        kind = str(by_name[name].type)
        try:
            if "bool" in kind:
                text = str(value).lower()
                if text not in ("true", "false"):
                    raise ValueError(text)
                values[by_name[name].name] = text == "true"
            else:
                values[by_name[name].name] = int(value) if "int" in kind else str(value)
        except ValueError as error:
            raise OptionError(f"option {name}: {value!r} is not a {kind}") from error
    missing = [_NAMES.get(f.name, f.name.replace("_", "-")) for f in fields(cls) if f.metadata.get("required") and not str(values.get(f.name, "")).strip()]
    if missing:
        raise OptionError(f"missing options: {', '.join(missing)}")
    return cls(**values)


def _required() -> Any:
    return field(default="", metadata={"required": True})


def _secret(required: bool = False) -> Any:
    return field(default="", repr=False, metadata={"required": required})


def _positive(options: object, *names: str) -> None:
    for name in names:
        if getattr(options, name) is not None and getattr(options, name) <= 0:
            raise OptionError(f"option {_NAMES.get(name, name)} must be above 0")


@dataclass(frozen=True)
class CdcOptions:
    """Options of the change source. The password never shows in a printed object."""

    hostname: str = _required()
    database: str = _required()
    table_name: str = _required()
    username: str = _required()
    password: str = _secret(required=True)
    port: int = 8000
    replication_port: int | None = None
    schema: str = "public"
    output_format: str = "raw"
    json_format: str = "debezium"
    slot_name: str = "change_slot"
    plugin_name: str | None = None
    snapshot_mode: bool = True
    chunk_size: int = 1000
    connect_timeout_ms: int = 30_000
    poll_interval_ms: int = 1000
    decode_plugin: str = "mppdb_decoding"
    parallel_decode_num: int = 1
    decode_style: str = "b"
    sending_batch: bool = False
    wal_mode: bool = False
    sslmode: str = "prefer"

    def __post_init__(self) -> None:
        _positive(self, "port", "replication_port", "chunk_size", "connect_timeout_ms", "poll_interval_ms")
        # What an option may be.
        allowed = {
            "output_format": ("raw", "json"),
            "json_format": ("debezium", "canal", "he"),
            "decode_plugin": ("mppdb_decoding", "pgoutput"),
            "decode_style": ("b", "j", "t"),
            "sslmode": ("disable", "allow", "prefer", "require", "verify-ca", "verify-full"),
        }
        for name, values in allowed.items():
            given = getattr(self, name).lower()
            if given not in values:
                raise OptionError(f"option {_NAMES.get(name, name.replace('_', '-'))} must be one of {', '.join(values)}")
            object.__setattr__(self, name, given)
        if not 1 <= self.parallel_decode_num <= 20:
            raise OptionError("option parallel-decode-num must be from 1 to 20")
        if self.plugin_name is not None and self.plugin_name.lower() != self.decode_plugin:
            raise OptionError("options decode.plugin and plugin.name differ")

    @classmethod
    def of(cls, options: dict[str, Any]) -> CdcOptions:
        given = {k.lower(): v for k, v in options.items()}
        if "plugin.name" in given:  # the old name of decode.plugin
            given.setdefault("decode.plugin", given["plugin.name"])
        return _from(cls, given)


@dataclass(frozen=True)
class JdbcOptions:
    """Options of the relational source and sink."""

    url: str = _required()
    table_name: str = _required()
    driver: str | None = None
    username: str | None = None
    password: str = _secret()
    partition_column: str | None = None
    partition_num: int | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    fetch_size: int = 0
    auto_commit: bool = True
    buffer_rows: int = 100
    buffer_interval_ms: int = 1000
    max_retries: int = 3
    parallelism: int | None = None
    ignore_null: bool = False
    connection_timeout_s: int = 60

    def __post_init__(self) -> None:
        split = [self.partition_column, self.partition_num, self.lower_bound, self.upper_bound]
        if any(x is not None for x in split) and any(x is None for x in split):
            raise OptionError("the options scan.partition.* come together or not at all")
        if self.partition_column is not None and self.lower_bound > self.upper_bound:
            raise OptionError("scan.partition.lower-bound must not be above scan.partition.upper-bound")
        if (self.username is None) != (not self.password):
            raise OptionError("username and password come together or not at all")
        if self.max_retries < 0 or self.fetch_size < 0:
            raise OptionError("sink.max-retries and scan.fetch-size must not be negative")
        _positive(self, "partition_num", "buffer_rows", "parallelism", "connection_timeout_s")

    of = classmethod(_from)


@dataclass(frozen=True)
class CatalogOptions:
    """Options of the catalog."""

    default_database: str = _required()
    username: str = _required()
    password: str = _secret(required=True)
    base_url: str = _required()

    of = classmethod(_from)
