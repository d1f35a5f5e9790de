"""Time expressions. The clock is always an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: str | datetime | Column) -> Column:
    """Literal or column as a timestamp without zone."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_utc(c: Column) -> Column:
    """Lenient parse to a timestamp; null for anything unreadable."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(c), r"^(\d{4}-\d{2}-\d{2}) ", "$1T"))


def trunc_ntz(unit: str, c: Column) -> Column:
    """``date_trunc`` that keeps timestamps without zone."""
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def as_utc(c: Column) -> Column:
    """Naive values are read as UTC (the session zone)."""
    return c.cast("timestamp")


def whole_days_between(a: Column, b: Column) -> Column:
    """Absolute number of full 24-hour days (``datediff`` would count midnights)."""
    seconds = F.abs(F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp")))
    return F.floor(seconds / F.lit(86_400_000_000))


def within_last(c: Column, as_of: str | datetime | Column, interval: str) -> Column:
    """``c > as_of - interval``; the raw column stays bare, so the filter is pushed down."""
    return c > moment(as_of) - F.expr(f"INTERVAL {interval}")


def on_day(c: Column, day: str) -> Column:
    """Half-open day range on the raw column, so the filter is pushed down."""
    start = moment(f"{day} 00:00:00")
    return (c >= start) & (c < start + F.expr("INTERVAL 1 DAY"))


def from_epoch(c: Column) -> Column:
    return F.timestamp_seconds(c)


def day_path(c: Column) -> Column:
    return F.date_format(c, "yyyy/MM/dd")


def seconds_since(as_of: str | datetime | Column, c: Column) -> Column:
    delta = F.unix_micros(moment(as_of).cast("timestamp")) - F.unix_micros(c.cast("timestamp"))
    return delta / F.lit(1_000_000.0)
