"""Assignment of rows to batches of a set size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batch_numbers(df: DataFrame, size: int, within: list[str], order: list[Column], into: str = "batch") -> DataFrame:
    """The batch of each row: ``size`` rows each, in order, starting anew in each group."""
    if size < 1:
        raise ValueError("a batch has a row at least")
    at = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return df.withColumn(into, F.floor((at - 1) / F.lit(size)).cast("bigint"))
