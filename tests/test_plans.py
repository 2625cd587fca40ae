"""Ranges, types and conversions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsink.plans.conversion import bind, convert, needs_check, overflow_counts, plan
from colsink.plans.ranges import BIT, Range, decimal_bits, decimal_digits, source_integer, stored_integer
from colsink.plans.types import ConversionError, TargetColumn, spark_type, sql_type, stored_schema, table_columns


def col(name, sql):
    return TargetColumn.parse(name, sql)


def test_ranges_are_symmetric_when_stored():
    assert stored_integer(8) == Range(-127, 127) and source_integer(8) == Range(-128, 127)
    assert stored_integer(64).hi == 2**63 - 1 and -(2**63) not in stored_integer(64)
    assert decimal_digits(3) == Range(-999, 999) and decimal_digits(1).covers(BIT)
    assert not stored_integer(16).covers(source_integer(16)) and stored_integer(16).covers(source_integer(8))


@pytest.mark.parametrize("precision,bits", [(1, 8), (2, 8), (3, 16), (4, 16), (5, 32), (9, 32), (10, 64), (18, 64), (19, 128), (38, 128), (39, -1), (0, -1)])
def test_decimal_widths(precision, bits):
    assert decimal_bits(precision) == bits


@pytest.mark.parametrize(
    "kind,sql",
    [
        (T.BooleanType(), "BOOLEAN"),
        (T.ByteType(), "SMALLINT"),
        (T.ShortType(), "INTEGER"),
        (T.IntegerType(), "BIGINT"),
        (T.LongType(), "BIGINT"),
        (T.FloatType(), "REAL"),
        (T.DoubleType(), "DOUBLE"),
        (T.DecimalType(8, 2), "DECIMAL(8,2)"),
        (T.TimestampType(), "TIMESTAMP WITH TIME ZONE"),
        (T.TimestampNTZType(), "TIMESTAMP"),
        (T.DateType(), "DATE"),
        (T.StringType(), "CLOB"),
        (T.VarcharType(7), "VARCHAR(7)"),
        (T.BinaryType(), "BLOB"),
    ],
)
def test_types_of_new_tables(kind, sql):
    assert sql_type(kind) == sql


@pytest.mark.parametrize("kind", [T.ArrayType(T.LongType()), T.NullType(), T.YearMonthIntervalType(), T.StructType([])])
def test_types_without_a_column(kind):
    with pytest.raises(ConversionError):
        sql_type(kind)


@pytest.mark.parametrize(
    "sql,kind",
    [
        ("tinyint", T.ByteType()),
        ("smallint", T.ShortType()),
        ("int", T.IntegerType()),
        ("bigint", T.LongType()),
        ("numeric(7,3)", T.DecimalType(7, 3)),
        ("real", T.FloatType()),
        ("double precision", T.DoubleType()),
        ("timestamp with time zone", T.TimestampType()),
        ("timestamp", T.TimestampNTZType()),
        ("text", T.StringType()),
        ("character varying(10)", T.StringType()),
        ("char(8)", T.StringType()),
        ("blob", T.BinaryType()),
        ("date", T.DateType()),
        ("interval year", T.YearMonthIntervalType(0, 0)),
        ("interval year to month", T.YearMonthIntervalType(0, 1)),
        ("interval month", T.YearMonthIntervalType(1, 1)),
        ("interval day to second", T.DayTimeIntervalType(0, 3)),
        ("interval hour to minute", T.DayTimeIntervalType(1, 2)),
        ("interval second", T.DayTimeIntervalType(3, 3)),
    ],
)
def test_types_of_stored_columns(sql, kind):
    assert spark_type(sql) == kind


@pytest.mark.parametrize("sql", ["time", "point", "interval second to day", "", "decimal(", "int unsigned"])
def test_unknown_types(sql):
    with pytest.raises(ConversionError):
        spark_type(sql)


def cast(spark, values, source, target, nulls=True):
    df = spark.createDataFrame([(v,) for v in values], f"x {source}")
    return [r[0] for r in plan(df, [col("x", target)], nulls).collect()]


def test_integers_lose_what_would_be_null(spark):
    assert cast(spark, [-128, -127, 127, None], "tinyint", "TINYINT") == [None, -127, 127, None]
    assert cast(spark, [32767, 32768, -32768], "int", "SMALLINT") == [32767, None, None]
    assert cast(spark, [-(2**63), 2**63 - 1], "bigint", "BIGINT") == [None, 2**63 - 1]
    assert cast(spark, [0, 1, 2, None], "int", "BOOLEAN") == [False, True, None, None]
    assert cast(spark, [True, False, None], "boolean", "INTEGER") == [1, 0, None]
    assert cast(spark, [True, None], "boolean", "BOOLEAN") == [True, None]


def test_decimals(spark):
    assert cast(spark, [99_999_999, 100_000_000], "int", "DECIMAL(8,0)") == [Decimal(99_999_999), None]
    wide = [Decimal(32767), Decimal(32768), None, Decimal(10) ** 32]
    assert cast(spark, wide, "decimal(33,0)", "SMALLINT") == [32767, None, None, None]
    assert cast(spark, [Decimal("1.25"), None], "decimal(12,2)", "DECIMAL(38,2)") == [Decimal("1.25"), None]
    assert cast(spark, [Decimal("9.99"), Decimal("10.00")], "decimal(38,2)", "DECIMAL(3,2)") == [Decimal("9.99"), None]
    assert cast(spark, [2**62], "bigint", "DECIMAL(38,0)") == [Decimal(2**62)]


def test_a_null_first_row_is_no_error(spark):
    assert cast(spark, [None, Decimal(5)], "decimal(33,0)", "SMALLINT", nulls=False) == [None, 5]


def test_floats_must_be_finite_after_narrowing(spark):
    odd = [1.5, float("nan"), float("inf"), -float("inf"), 1e300, None]
    assert cast(spark, odd, "double", "REAL") == [1.5, None, None, None, None, None]
    assert cast(spark, odd, "double", "DOUBLE") == [1.5, None, None, None, 1e300, None]


@pytest.mark.parametrize("source,value,target", [("int", 70_000, "SMALLINT"), ("double", float("inf"), "DOUBLE"), ("decimal(20,0)", Decimal(300), "TINYINT")])
def test_overflow_fails_by_default(spark, source, value, target):
    with pytest.raises(Exception, match="Value out of range"):
        cast(spark, [value], source, target, nulls=False)


def test_temporal_and_bytes(spark):
    day, noon = dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 12)
    assert cast(spark, [day, None], "date", "DATE") == [day, None]
    assert cast(spark, [noon], "timestamp_ntz", "TIMESTAMP WITH TIME ZONE")[0] is not None
    assert cast(spark, [noon], "timestamp", "TIMESTAMP") == [noon]
    assert cast(spark, [bytearray(b"\0\xff")], "binary", "VARBINARY") == [bytearray(b"\0\xff")]
    assert cast(spark, ["é", ""], "string", "CHAR(3)") == ["é", ""]


@pytest.mark.parametrize(
    "source,target",
    [("int", "DOUBLE"), ("double", "BIGINT"), ("string", "INTEGER"), ("decimal(5,2)", "DECIMAL(5,1)"), ("int", "DECIMAL(5,1)"), ("date", "TIMESTAMP"), ("array<int>", "INTEGER"), ("interval month", "INTEGER"), ("binary", "CLOB")],
)
def test_no_conversion(spark, source, target):
    with pytest.raises(ConversionError):
        plan(spark.createDataFrame([], f"x {source}"), [col("x", target)])


def test_checks_are_left_out_where_none_is_needed(spark):
    assert not needs_check(T.ByteType(), col("x", "SMALLINT")) and needs_check(T.ShortType(), col("x", "SMALLINT"))
    assert not needs_check(T.IntegerType(), col("x", "DECIMAL(10,0)")) and needs_check(T.IntegerType(), col("x", "DECIMAL(9,0)"))
    bare = convert(F.col("x"), T.ShortType(), col("x", "BIGINT"))
    assert "raise_error" not in str(bare) and "CASE" not in str(bare)


def test_columns_meet_by_exact_name(spark):
    df = spark.createDataFrame([(5, "a")], "x int, y string")
    targets = [col("z", "INT"), col("y", "TEXT"), col("x", "BIGINT")]
    assert [t.name for _, t in bind(df.schema, targets)] == ["x", "y"]
    assert plan(df, targets).collect() == [(5, "a")]
    with pytest.raises(ConversionError, match="Y"):
        plan(df.withColumnRenamed("y", "Y"), targets)


def test_overflow_counts(spark):
    df = spark.createDataFrame([(1, 300), (None, 5), (70_000, None)], "a int, b int")
    assert overflow_counts(df, [col("a", "SMALLINT"), col("b", "TINYINT")]).collect() == [(1, 1)]
    assert overflow_counts(df.limit(0), [col("a", "SMALLINT"), col("b", "TINYINT")]).collect() == [(0, 0)]


def test_table_columns_and_back():
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("d", T.DecimalType(5, 1))])
    assert stored_schema(table_columns(schema)).simpleString() == "struct<i:bigint,d:decimal(5,1)>"
