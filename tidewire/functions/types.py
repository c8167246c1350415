"""Types: database names to Spark types, type names to object identifiers, and values from log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class UnsupportedTypeError(ValueError):
    """A database type without a counterpart here."""


MAX_PRECISION, DEFAULT_SCALE = 38, 18
#: Limits of the SQL dialect itself.
DECIMAL_PRECISION, TIMESTAMP_PRECISION = (1, 1000), (0, 6)

# Type names and their Spark types.
_PLAIN: dict[str, T.DataType] = {
    "bool": T.BooleanType(),
    "bytea": T.BinaryType(),
    "int2": T.ShortType(),
    "smallserial": T.ShortType(),
    "int4": T.IntegerType(),
    "serial": T.IntegerType(),
    "int8": T.LongType(),
    "bigserial": T.LongType(),
    "float4": T.FloatType(),
    "float8": T.DoubleType(),
    "text": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "time": T.StringType(),
    "date": T.DateType(),
}
_SERIAL = {"smallserial", "serial", "bigserial"}

# Object identifiers of the types that log records carry.
OIDS: dict[str, int] = {
    "boolean": 16,
    "bool": 16,
    "bigint": 20,
    "int8": 20,
    "smallint": 21,
    "int2": 21,
    "integer": 23,
    "int": 23,
    "int4": 23,
    "text": 25,
    "real": 700,
    "float4": 700,
    "double precision": 701,
    "float8": 701,
    "character": 1042,
    "char": 1042,
    "character varying": 1043,
    "varchar": 1043,
    "date": 1082,
    "timestamp": 1114,
    "timestamp without time zone": 1114,
    "timestamp with time zone": 1184,
    "timestamptz": 1184,
    "numeric": 1700,
    "decimal": 1700,
}
TEXT_OID = 25


def map_type(name: str, precision: int = 0, scale: int = 0, char_metadata: bool = False) -> T.DataType:
    """The Spark type of a database type by its driver name; ``_name`` is an array of it.

    CHAR and VARCHAR lengths are types of their own only with ``char_metadata``; TIME is a string; a numeric
    without precision is decimal(38,18).
    """
    base = name.lower()
    if base.startswith("_"):
        if base[1:] in _SERIAL:
            raise UnsupportedTypeError(f"no Spark type for database type '{name}'")
        return T.ArrayType(map_type(base[1:], precision, scale, char_metadata))
    if base in _PLAIN:
        return _PLAIN[base]
    if base == "numeric":
        if precision <= 0:
            return T.DecimalType(MAX_PRECISION, DEFAULT_SCALE)
        if precision > MAX_PRECISION:
            raise UnsupportedTypeError(f"numeric({precision},{scale}) has more than {MAX_PRECISION} digits")
        return T.DecimalType(precision, scale)
    if base in ("bpchar", "character"):
        return T.CharType(precision) if char_metadata and precision > 0 else T.StringType()
    if base == "varchar":
        return T.VarcharType(precision) if char_metadata and precision > 0 else T.StringType()
    raise UnsupportedTypeError(f"no Spark type for database type '{name}'")


def check_dialect_type(kind: T.DataType, precision: int | None = None) -> None:
    """Raises if the SQL dialect has no such column type; ``precision`` is that of a timestamp."""
    if isinstance(kind, T.ArrayType):
        return check_dialect_type(kind.elementType, precision)
    if isinstance(kind, T.DecimalType) and not DECIMAL_PRECISION[0] <= kind.precision <= DECIMAL_PRECISION[1]:
        raise UnsupportedTypeError(f"decimal precision must be from {DECIMAL_PRECISION[0]} to {DECIMAL_PRECISION[1]}")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType) and precision is not None and not TIMESTAMP_PRECISION[0] <= precision <= TIMESTAMP_PRECISION[1]:
        raise UnsupportedTypeError(f"timestamp precision must be from {TIMESTAMP_PRECISION[0]} to {TIMESTAMP_PRECISION[1]}")
    if isinstance(kind, T.MapType | T.StructType | T.VariantType | T.DayTimeIntervalType | T.YearMonthIntervalType):
        raise UnsupportedTypeError(f"the dialect has no column type for {kind.simpleString()}")
    return None


def type_oid(name: Column) -> Column:
    """The object identifier of a type name, in any case; text for null and unknown names."""
    table = F.create_map(*(x for k, v in OIDS.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.lit(TEXT_OID))


def spark_type_of_oid(oid: int, precision: int = MAX_PRECISION, scale: int = DEFAULT_SCALE) -> T.DataType:
    """The Spark type that ``cast_value`` gives for an object identifier."""
    # The identifiers that are more than text.
    return {
        16: T.BooleanType(), 20: T.LongType(), 21: T.IntegerType(), 23: T.IntegerType(), 700: T.FloatType(), 701: T.DoubleType(),
        1082: T.DateType(), 1114: T.TimestampNTZType(), 1700: T.DecimalType(precision, scale),
    }.get(oid, T.StringType())


def cast_value(value: Column, kind: T.DataType) -> Column:
    """Log text as a value; null where the text isn't one (``convertible`` tells the two apart).

    ``t`` and ``f`` are booleans; a timestamp may have any number of fraction digits, of which six are kept.
    """
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.TimestampNTZType):
        return F.regexp_replace(value, r"(\.\d{6})\d+", "$1").try_cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(F.regexp_replace(value, r"^\\x", ""), F.lit("hex"))
    return F.trim(value).try_cast(kind)


def cast_by_oid(value: Column, oid: int, precision: int = MAX_PRECISION, scale: int = DEFAULT_SCALE) -> Column:
    return cast_value(value, spark_type_of_oid(oid, precision, scale))


def convertible(value: Column, kind: T.DataType) -> Column:
    """False where a value that isn't null has no value of that type."""
    return value.isNull() | cast_value(value, kind).isNotNull()
