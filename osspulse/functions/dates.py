"""Calendar arithmetic.

All differences count boundaries crossed, not whole elapsed units: 10:59 to 11:01 is one
hour, Jan 31 to Feb 1 is one month. Everything is integer arithmetic on date parts, so it
stays inside generated code and works alike for dates, timestamps with and without zone.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """YYYYMMDD as an int; NULL stays NULL."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def day_diff(start: Column, end: Column) -> Column:
    """Midnights between `start` and `end`."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hour_diff(start: Column, end: Column) -> Column:
    """Full hours on the clock passed between `start` and `end`."""
    return (day_diff(start, end) * 24 + F.hour(end) - F.hour(start)).cast("bigint")


def month_diff(start: Column, end: Column) -> Column:
    """First-of-months passed between `start` and `end`."""
    years = F.year(end) - F.year(start)
    return (years * 12 + F.month(end) - F.month(start)).cast("bigint")


def month_start(ts: Column) -> Column:
    """First day of the month, as a timestamp without zone."""
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_name(day: Column) -> Column:
    """Full English month name (the built-in `monthname` is abbreviated)."""
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    """Full English weekday name (the built-in `dayname` is abbreviated)."""
    return F.date_format(day, "EEEE")


def day_of_week(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("bigint")


def utc_naive(moment: datetime) -> datetime:
    """The UTC clock time of `moment`; a moment without zone is taken as UTC."""
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def utc_literal(moment: datetime) -> Column:
    """Timestamp literal that does not depend on the zone of the driver process."""
    return F.lit(utc_naive(moment).isoformat(sep=" ") + "+00:00").cast("timestamp")
