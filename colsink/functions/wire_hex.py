"""Wire values as upper-case hex text, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colsink.functions.temporal import date_fields, timestamp_fields


def little_endian(value: Column, size: int) -> Column:
    """The low ``size`` bytes of an integer, least first; the null mark where it is null."""
    digits = 2 * size
    big = F.right(F.lpad(F.hex(value.cast("bigint")), F.lit(16), F.lit("0")), F.lit(digits))
    pairs = F.regexp_extract_all(big, F.lit("(..)"), F.lit(1))
    return F.when(value.isNotNull(), F.concat_ws("", F.reverse(pairs))).otherwise(F.lit("00" * (size - 1) + "80"))


def text(value: Column) -> Column:
    """UTF-8 bytes and a zero byte; 8000 where it is null."""
    return F.coalesce(F.concat(F.hex(F.encode(value, "UTF-8")), F.lit("00")), F.lit("8000"))


def blob(value: Column) -> Column:
    """An eight-byte length and the bytes; eight bytes of ones where it is null."""
    return F.coalesce(F.concat(little_endian(F.octet_length(value), 8), F.hex(value)), F.lit("FF" * 8))


def date(value: Column) -> Column:
    """Day, month, and year in two bytes."""
    f = date_fields(value)
    made = F.concat(little_endian(f["day"], 1), little_endian(f["month"], 1), little_endian(f["year"], 2))
    return F.when(value.isNotNull(), made).otherwise(F.lit("FF" * 4))


def timestamp(value: Column) -> Column:
    """Microseconds in four bytes, second, minute, hour, a zero byte, and the date."""
    f = timestamp_fields(value)
    clock = [little_endian(f["micro"], 4), *[little_endian(f[k], 1) for k in ("second", "minute", "hour")], F.lit("00")]
    made = F.concat(*clock, little_endian(f["day"], 1), little_endian(f["month"], 1), little_endian(f["year"], 2))
    return F.when(value.isNotNull(), made).otherwise(F.lit("FF" * 12))


def back_reference(delta: Column) -> Column:
    """A back-reference: one byte below 64, else 80 and groups of seven bits, low first."""

    def group(k: int) -> Column:
        return F.shiftright(delta, 7 * k).bitwiseAND(F.lit(127))

    def coded(n: int) -> Column:
        return F.concat(F.lit("80"), *[little_endian(group(k) + F.lit(128 if k < n - 1 else 0), 1) for k in range(n)])

    out = F.when(delta < 64, little_endian(delta + 128, 1))
    for n in range(1, 6):
        out = out.when(delta < (1 << (7 * n)), coded(n))
    return out
