"""Dates, timestamps and intervals between wire values and Spark's types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(ts: Column) -> Column:
    """A timestamp's wall-clock fields in the session's zone."""
    return ts.cast("timestamp_ntz")


def instant(ts: Column) -> Column:
    """A wall-clock timestamp as an instant in the session's zone; instants stay as they are."""
    return ts.cast("timestamp")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, wall-clock fields taken as UTC where the session is in UTC."""
    return F.unix_micros(instant(ts))


def year_month(months: Column) -> Column:
    """An interval of so many months."""
    return F.make_ym_interval(F.lit(0), months.cast("int"))


def day_time(seconds: Column) -> Column:
    """An interval of decimal seconds; the sign of a part of a second is kept."""
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def day_time_micros(seconds: Column) -> Column:
    """Microseconds of a text or decimal number of seconds."""
    return (seconds.cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")


def date_fields(d: Column) -> dict[str, Column]:
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def timestamp_fields(ts: Column) -> dict[str, Column]:
    """Calendar fields and the microseconds of the second."""
    clock = {"hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts)}
    return date_fields(ts) | clock | {"micro": F.pmod(micros(ts), F.lit(1_000_000)).cast("int")}
