"""The catalog: databases, tables and schemas, from the server's own metadata tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import BUILTIN_DATABASES, BUILTIN_SCHEMAS, TablePath
from ..functions.options import CatalogOptions
from ..functions.types import map_type


class CatalogError(RuntimeError):
    """The catalog could not answer."""


class DatabaseNotFoundError(CatalogError):
    """There is no such database."""


class TableNotFoundError(CatalogError):
    """There is no such table."""


def databases_of(databases: DataFrame) -> DataFrame:
    """Databases (datname) without the server's own."""
    return databases.filter(~F.col("datname").isin(*BUILTIN_DATABASES)).select("datname")


def tables_of(tables: DataFrame) -> DataFrame:
    """(table_schema, table_name, table_type) as ``schema.table``: base tables outside of the server's own schemas."""
    own = F.col("table_schema").isin(*BUILTIN_SCHEMAS)
    rows = tables.filter(~own & (F.col("table_type") == "BASE TABLE"))
    return rows.orderBy("table_type", "table_schema", "table_name").select(F.concat_ws(".", "table_schema", "table_name").alias("name"))


def key_columns(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, key_columns, capturable): a table can be captured if its primary key is one column."""
    found = keys.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "column_name"))).alias("k"))  # a key has few columns
    rows = names.join(found, "name", "left").withColumn("k", F.coalesce("k", F.array().cast("array<struct<place:int,column_name:string>>")))
    return rows.select("name", F.array_join(F.col("k.column_name"), ",").alias("key_columns"), (F.size("k") == 1).alias("capturable"))


#: Reads a query's rows from a database: (database, SQL) to a DataFrame.
Reader = Callable[[str, str], DataFrame]

_DATABASES = "SELECT datname FROM pg_database"
_TABLES = "SELECT table_schema, table_name, table_type FROM information_schema.tables"
_COLUMNS = (
    "SELECT column_name, udt_name, coalesce(character_maximum_length, numeric_precision, 0) AS p, coalesce(numeric_scale, datetime_precision, 0) AS s, is_nullable "
    "FROM information_schema.columns WHERE table_schema = '{schema}' AND table_name = '{table}' ORDER BY ordinal_position"
)


_KEYS = (
    "SELECT k.column_name, k.ordinal_position AS place FROM information_schema.table_constraints c JOIN information_schema.key_column_usage k "
    "ON k.constraint_schema = c.constraint_schema AND k.constraint_name = c.constraint_name "
    "WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = '{schema}' AND c.table_name = '{table}'"
)


@dataclass(frozen=True)
class Table:
    """A table's columns, and the columns of its primary key in their order, which may be several or none."""

    schema: T.StructType
    primary_key: tuple[str, ...] = ()


def jdbc_reader(spark: SparkSession, options: CatalogOptions) -> Reader:
    """Reads over JDBC; each database has its own address."""
    base = options.base_url.rstrip("/")
    given = {"user": options.username, "password": options.password}
    return lambda database, sql: spark.read.format("jdbc").options(url=f"{base}/{database}", query=sql, **given).load()


class Catalog:
    """Databases and tables of a server. A table's name is ``schema.table``, or ``table`` in the schema ``public``."""

    def __init__(self, read: Reader, default_database: str):
        self.read, self.default_database = read, default_database

    def list_databases(self) -> list[str]:
        return [r[0] for r in databases_of(self.read(self.default_database, _DATABASES)).orderBy("datname").collect()]

    def list_tables(self, database: str) -> list[str]:
        if not database or not database.strip():
            raise ValueError("a database must have a name")
        if database not in self.list_databases():
            raise DatabaseNotFoundError(database)
        try:
            return [r[0] for r in tables_of(self.read(database, _TABLES)).collect()]
        except Exception as error:
            raise CatalogError(f"tables of {database} could not be listed") from error

    def table_exists(self, database: str, name: str) -> bool:
        try:
            return str(TablePath.parse(name)) in self.list_tables(database)
        except DatabaseNotFoundError:
            return False

    def table_schema(self, database: str, name: str) -> T.StructType:
        return self.table(database, name).schema

    def table(self, database: str, name: str) -> Table:
        if not self.table_exists(database, name):
            raise TableNotFoundError(f"{database}.{name}")
        path = TablePath.parse(name)
        named = {"schema": path.schema.replace("'", "''"), "table": path.table.replace("'", "''")}
        schema = T.StructType()
        for column, kind, p, s, nullable in self.read(database, _COLUMNS.format(**named)).collect():
            schema.add(column, map_type(kind, p, s), nullable == "YES")
        keys = sorted(self.read(database, _KEYS.format(**named)).collect(), key=lambda r: r[1])
        return Table(schema, tuple(r[0] for r in keys))


def open_catalog(spark: SparkSession, options: CatalogOptions) -> Catalog:
    """The catalog of a server, over JDBC."""
    return Catalog(jdbc_reader(spark, options), options.default_database)
