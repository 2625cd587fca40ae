"""Checked conversion of a DataFrame's columns to a target's, as column expressions.

Columns meet by exact name. Integer-like values are checked against what the target can
store, and only where the source's range isn't within it; floats must be finite after
narrowing. What is out of range becomes null or fails the query, as the caller asks.
Everything stays in generated code; no row is looked at in Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colsink.plans.ranges import BIT, Range, decimal_digits, source_integer
from colsink.plans.types import BINARIES, STRINGS, TIMESTAMPS, ConversionError, TargetColumn, spark_type

OVERFLOW = "Value out of range"
_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def source_range(kind: T.DataType) -> Range | None:
    """Values an integer-like source may hold, unscaled; None for other types."""
    if isinstance(kind, T.BooleanType):
        return BIT
    if isinstance(kind, T.DecimalType):
        return decimal_digits(kind.precision)
    return source_integer(_WHOLE[type(kind)]) if type(kind) in _WHOLE else None


def needs_check(kind: T.DataType, target: TargetColumn) -> bool:
    """Some value of the source type can't be stored in the target."""
    source, stored = source_range(kind), target.range
    if source is None or stored is None:
        return isinstance(kind, (T.FloatType, T.DoubleType))
    return not stored.covers(source)


def _whole(value: Column, kind: T.DataType, target: TargetColumn, null_on_overflow: bool) -> Column:
    to = spark_type(target.sql)
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    if scale != target.scale:
        raise ConversionError(f"column {target.name}: {kind.simpleString()} has another scale than {target.sql}")
    if isinstance(kind, T.BooleanType):
        value = value.cast("int")
    stored = target.range

    def out(v: Column) -> Column:
        return v != 0 if target.kind == "BOOLEAN" else v.cast(to)

    if not needs_check(kind, target):
        return out(value)
    exact = Context(prec=60)
    lo, hi = (Decimal(x).scaleb(-scale, exact) for x in (stored.lo, stored.hi))
    if isinstance(kind, T.DecimalType):
        # bounds beyond 38 digits can't be reached by any decimal
        bounds = [F.lit(str(b)).cast(T.DecimalType(38, scale)) for b in (lo, hi)]
    else:
        whole = source_integer(64)
        bounds = [F.lit(min(max(x, whole.lo), whole.hi)) for x in (stored.lo, stored.hi)]
        value = value.cast("bigint")
    ok = (value >= bounds[0]) & (value <= bounds[1])
    fine = F.when(ok, out(value))
    return fine if null_on_overflow else fine.when(value.isNotNull(), F.raise_error(F.lit(OVERFLOW)))


def _real(value: Column, target: TargetColumn, null_on_overflow: bool) -> Column:
    narrowed = value.cast(spark_type(target.sql))
    finite = ~F.isnan(narrowed) & (F.abs(narrowed) < F.lit(float("inf")))
    fine = F.when(finite, narrowed)
    return fine if null_on_overflow else fine.when(value.isNotNull(), F.raise_error(F.lit(OVERFLOW)))


def convert(value: Column, kind: T.DataType, target: TargetColumn, null_on_overflow: bool = False) -> Column:
    """``value`` of type ``kind`` as ``target`` stores it; ConversionError where no rule allows it."""
    to = spark_type(target.sql) if not target.kind.startswith("INTERVAL ") else None
    if source_range(kind) is not None and target.range is not None:
        return _whole(value, kind, target, null_on_overflow)
    if isinstance(kind, T.StringType) and target.kind in STRINGS:
        return value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)) and target.kind in ("REAL", "DOUBLE"):
        return _real(value, target, null_on_overflow)
    if isinstance(kind, T.DateType) and target.kind == "DATE":
        return value
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and target.kind in TIMESTAMPS:
        return value.cast(to)
    if isinstance(kind, T.BinaryType) and target.kind in BINARIES:
        return value
    raise ConversionError(f"column {target.name}: {kind.simpleString()} can't be written to {target.sql}")


def bind(schema: T.StructType, targets: Sequence[TargetColumn]) -> list[tuple[T.StructField, TargetColumn]]:
    """Pairs in the DataFrame's order, by exact name; targets without a source column are left out."""
    by_name = {t.name: t for t in targets}
    missing = [f.name for f in schema if f.name not in by_name]
    if missing:
        raise ConversionError(f"the target has no column {', '.join(missing)}")
    return [(f, by_name[f.name]) for f in schema]


def plan(df: DataFrame, targets: Sequence[TargetColumn], null_on_overflow: bool = False) -> DataFrame:
    """``df`` with each column as its target stores it."""
    pairs = bind(df.schema, targets)
    return df.select(*[convert(F.col(f"`{f.name}`"), f.dataType, t, null_on_overflow).alias(f.name) for f, t in pairs])


def overflow_counts(df: DataFrame, targets: Sequence[TargetColumn]) -> DataFrame:
    """One row: how many values of each column its target can't store."""
    pairs = bind(df.schema, targets)

    def lost(f: T.StructField, t: TargetColumn) -> Column:
        kept = convert(F.col(f"`{f.name}`"), f.dataType, t, True)
        return F.coalesce(F.sum((F.col(f"`{f.name}`").isNotNull() & kept.isNull()).cast("bigint")), F.lit(0)).alias(f.name)

    return df.agg(*[lost(f, t) for f, t in pairs])
