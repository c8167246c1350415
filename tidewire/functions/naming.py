"""Names: quoting, table paths, and which tables a pattern means."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCHEMA = "public"
# What the server itself owns.
BUILTIN_DATABASES = ("template0", "template1")
BUILTIN_SCHEMAS = ("pg_catalog", "pg_toast", "information_schema", "dbe_perf", "snapshot")
#: A name with one of these characters is a pattern.
_PATTERN = re.compile(r"[.*+?^$\[\]()|\\]")


def quote(name: str | None, mark: str = '"') -> str:
    """A quoted identifier, with quote marks in it doubled."""
    if name is None:
        raise ValueError("an identifier must not be null")
    return f"{mark}{name.replace(mark, mark * 2)}{mark}"


def qualified(schema: str | None, table: str, mark: str = '"') -> str:
    return f"{quote(schema, mark)}.{quote(table, mark)}"


def column_list(names: list[str], mark: str = '"') -> str:
    return ", ".join(quote(n, mark) for n in names)


def quote_mark(sql_compatibility: str | None, driver_mark: str | None) -> str:
    """The quote mark: a backtick in M compatibility, else what the driver says, else a double quote."""
    if (sql_compatibility or "").strip().upper() == "M":
        return "`"
    return (driver_mark or "").strip() or '"'


@dataclass(frozen=True)
class TablePath:
    schema: str
    table: str

    @classmethod
    def parse(cls, text: str) -> TablePath:
        """``table`` or ``schema.table``."""
        parts = text.split(".")
        if len(parts) > 2:
            raise ValueError(f"Table name '{text}' is not valid. The parsed length is {len(parts)}")
        schema, table = parts if len(parts) == 2 else (DEFAULT_SCHEMA, parts[0])
        if not schema.strip() or not table.strip():
            raise ValueError(f"Table name '{text}' has an empty part")
        return cls(schema, table)

    def __str__(self) -> str:
        return f"{self.schema}.{self.table}"


def is_pattern(table_name: str) -> bool:
    return bool(_PATTERN.search(table_name))


def table_matches(schema: Column, table: Column, wanted_schema: str, wanted: str) -> Column:
    """Whether a table is meant: the schema equals in any case, the name equals in any case or, if ``wanted`` is a
    pattern, matches it as a whole in any case. Null names match nothing."""
    name = table.rlike(f"(?i)^(?:{wanted})$") if is_pattern(wanted) else F.lower(table) == wanted.lower()
    return F.coalesce((F.lower(schema) == wanted_schema.lower()) & name, F.lit(False))


def table_matches_text(schema: str | None, table: str | None, wanted_schema: str, wanted: str) -> bool:
    """``table_matches`` for one pair of names, outside of Spark."""
    if schema is None or table is None or schema.lower() != wanted_schema.lower():
        return False
    return bool(re.fullmatch(wanted, table, re.IGNORECASE)) if is_pattern(wanted) else table.lower() == wanted.lower()


def parse_path(text: Column) -> Column:
    """``TablePath.parse`` as a struct of schema and table; null where the text isn't a path."""
    parts = F.split(text, r"\.")
    schema = F.when(F.size(parts) == 2, parts[0]).otherwise(F.lit(DEFAULT_SCHEMA))
    table = F.element_at(parts, -1)
    good = (F.size(parts) <= 2) & (F.trim(schema) != "") & (F.trim(table) != "")
    return F.when(good, F.struct(schema.alias("schema"), table.alias("table")))


def split_qualified(text: Column) -> Column:
    """A name split at its last dot, as a struct of schema (null without a dot) and table."""
    has = F.instr(text, ".") > 0
    return F.struct(
        F.when(has, F.regexp_extract(text, r"^(.*)\.[^.]*$", 1)).alias("schema"),
        F.when(has, F.regexp_extract(text, r"([^.]*)$", 1)).otherwise(text).alias("table"),
    )
