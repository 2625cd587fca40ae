"""Scans of files and ranges: strides, probes and typed reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("orc", "parquet", "csv", "json")


def read_file(spark: SparkSession, path: str, kind: str | None = None, schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """Files of one format, by their ending where ``kind`` isn't given."""
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in FORMATS:
        raise ValueError(f"unknown file format {kind!r}; use one of {', '.join(FORMATS)}")
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def probe(df: DataFrame) -> DataFrame:
    """The columns without rows; no file is read."""
    return df.where(F.lit(False))


def stride(value: Column, lower: int, upper: int, parts: int) -> Column:
    """Which of ``parts`` equal strides a value falls in.

    The bounds only cut strides: values outside, and nulls, belong to the first or last.
    """
    if parts < 1 or upper <= lower:
        raise ValueError("a stride needs an upper bound above the lower and a part")
    width = max(1, (upper - lower) // parts)
    at = F.floor((value - F.lit(lower)) / F.lit(width))
    return F.when(value.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(parts - 1), at))).cast("int")


def in_strides(df: DataFrame, column: str, lower: int, upper: int, parts: int) -> DataFrame:
    """``df`` dealt into a partition for each stride of a numeric column."""
    return df.repartitionByRange(parts, stride(F.col(column), lower, upper, parts))
