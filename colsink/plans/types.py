"""Types of target columns, and the mappings between them and Spark's.

Three mappings: Spark to SQL when a table is created, SQL to Spark when one is read, and
the DataFrame column types that an existing column accepts (``plans.conversion``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

from colsink.plans.ranges import BIT, Range, decimal_bits, decimal_digits, stored_integer

INTEGER_BITS = {"TINYINT": 8, "SMALLINT": 16, "INTEGER": 32, "BIGINT": 64}
STRINGS = ("VARCHAR", "CHAR", "CLOB")
BINARIES = ("BLOB", "VARBINARY")
TIMESTAMPS = ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE")
_SAME = {
    "INT": "INTEGER",
    "BOOL": "BOOLEAN",
    "NUMERIC": "DECIMAL",
    "DEC": "DECIMAL",
    "FLOAT": "DOUBLE",
    "DOUBLE PRECISION": "DOUBLE",
    "TEXT": "CLOB",
    "STRING": "CLOB",
    "CHARACTER LARGE OBJECT": "CLOB",
    "CHARACTER": "CHAR",
    "CHARACTER VARYING": "VARCHAR",
    "BINARY LARGE OBJECT": "BLOB",
    "VARCHAR () FOR BIT DATA": "VARBINARY",
    "TIMESTAMPTZ": "TIMESTAMP WITH TIME ZONE",
    "TIMESTAMP WITH TIMEZONE": "TIMESTAMP WITH TIME ZONE",
}
_YEAR_MONTH = {"YEAR": 0, "MONTH": 1}
_DAY_TIME = {"DAY": 0, "HOUR": 1, "MINUTE": 2, "SECOND": 3}


class ConversionError(Exception):
    """A column can't be written to its target; raised before any job starts."""


@dataclass(frozen=True)
class TargetColumn:
    """A column of a stored table: its name, SQL kind, and digits where it has them."""

    name: str
    kind: str
    precision: int | None = None
    scale: int = 0

    @staticmethod
    def parse(name: str, sql_type: str) -> TargetColumn:
        """From a SQL type such as ``DECIMAL(8, 2)``, ``int`` or ``character varying(10)``."""
        m = re.fullmatch(r"\s*([A-Za-z][A-Za-z ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?((?:\s+[A-Za-z]+)*)\s*", sql_type)
        if not m:
            raise ConversionError(f"column {name}: unknown type {sql_type!r}")
        words = re.sub(r"\s+", " ", (m[1] + (" ()" if m[2] and m[4] else "") + m[4]).upper())
        kind = _SAME.get(words, words)
        known = kind in INTEGER_BITS or kind in STRINGS or kind in BINARIES or kind in TIMESTAMPS or kind in ("BOOLEAN", "DECIMAL", "REAL", "DOUBLE", "DATE")
        if not known and not kind.startswith("INTERVAL "):
            raise ConversionError(f"column {name}: unknown type {sql_type!r}")
        precision = int(m[2]) if m[2] else 18 if kind == "DECIMAL" else None
        return TargetColumn(name, kind, precision, int(m[3] or 0))

    @property
    def sql(self) -> str:
        if self.kind == "DECIMAL":
            return f"DECIMAL({self.precision},{self.scale})"
        return f"{self.kind}({self.precision})" if self.precision and self.kind in STRINGS + BINARIES else self.kind

    @property
    def bits(self) -> int | None:
        """Storage width of an integer-like column."""
        if self.kind == "BOOLEAN":
            return 8
        return decimal_bits(self.precision or 0) if self.kind == "DECIMAL" else INTEGER_BITS.get(self.kind)

    @property
    def range(self) -> Range | None:
        """Storable values of an integer-like column, unscaled."""
        if self.kind == "BOOLEAN":
            return BIT
        if self.kind == "DECIMAL":
            return decimal_digits(self.precision or 0)
        return stored_integer(INTEGER_BITS[self.kind]) if self.kind in INTEGER_BITS else None


def sql_type(kind: T.DataType) -> str:
    """SQL type of a new table's column. Integers are widened, as their least values would be nulls."""
    plain = {
        T.BooleanType: "BOOLEAN",
        T.ByteType: "SMALLINT",
        T.ShortType: "INTEGER",
        T.IntegerType: "BIGINT",
        T.LongType: "BIGINT",
        T.FloatType: "REAL",
        T.DoubleType: "DOUBLE",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.TimestampNTZType: "TIMESTAMP",
        T.BinaryType: "BLOB",
    }
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, (T.VarcharType, T.CharType)):
        return f"{'VARCHAR' if isinstance(kind, T.VarcharType) else 'CHAR'}({kind.length})"
    if isinstance(kind, T.StringType):
        return "CLOB"
    if type(kind) in plain:
        return plain[type(kind)]
    raise ConversionError(f"no SQL type for {kind.simpleString()}")


def table_columns(schema: T.StructType) -> list[TargetColumn]:
    """The columns a new table gets."""
    return [TargetColumn.parse(f.name, sql_type(f.dataType)) for f in schema]


def spark_type(sql: str) -> T.DataType:
    """Spark type of a stored column. Year-month intervals come as months, day-time ones as seconds."""
    column = TargetColumn.parse("", sql)
    plain = {
        "BOOLEAN": T.BooleanType(),
        "TINYINT": T.ByteType(),
        "SMALLINT": T.ShortType(),
        "INTEGER": T.IntegerType(),
        "BIGINT": T.LongType(),
        "REAL": T.FloatType(),
        "DOUBLE": T.DoubleType(),
        "DATE": T.DateType(),
        "TIMESTAMP": T.TimestampNTZType(),
        "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    }
    if column.kind.startswith("INTERVAL "):
        first, _, last = column.kind[9:].partition(" TO ")
        for fields, made in ((_YEAR_MONTH, T.YearMonthIntervalType), (_DAY_TIME, T.DayTimeIntervalType)):
            if first in fields and (last or first) in fields and fields[first] <= fields[last or first]:
                return made(fields[first], fields[last or first])
        raise ConversionError(f"unknown interval {sql!r}")
    if column.kind == "DECIMAL":
        return T.DecimalType(column.precision, column.scale)
    if column.kind in STRINGS:
        return T.StringType()
    return T.BinaryType() if column.kind in BINARIES else plain[column.kind]


def stored_schema(columns: Iterable[TargetColumn]) -> T.StructType:
    """Schema of a table's rows when read."""
    return T.StructType([T.StructField(c.name, spark_type(c.sql)) for c in columns])
