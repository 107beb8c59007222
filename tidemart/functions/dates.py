"""Date and time expressions. Bad text reads as null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def parse_date(c: Column) -> Column:
    return c.try_cast("date")


def date_key(c: Column) -> Column:
    """Integer YYYYMMDD."""
    d = F.to_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(key: Column) -> Column:
    """Date of an integer YYYYMMDD key."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start))


def whole_days_elapsed(start: Column, end: Column) -> Column:
    """Full 24-hour spans from start to end, rounded towards the past."""
    # between local times: no session zone, so no change of clocks, comes in
    seconds = F.timestamp_diff("SECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return F.floor(seconds / 86400)


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


def month_gap(earlier: Column, later: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def fiscal_year(c: Column) -> Column:
    """April-March year, labelled by the year it starts in."""
    return F.year(c) - F.when(F.month(c) >= 4, 0).otherwise(1)
