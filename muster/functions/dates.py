"""Calendar arithmetic with boundary-counting semantics.

Every function takes Columns (dates or timestamps, with or without zone) and returns a Column built
from Spark's own expressions, so all of it stays inside generated code.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Sunday. Week numbers count Sundays from here.
_FIRST_SUNDAY = dt.date(1899, 12, 31)


def as_date(value: dt.date | dt.datetime | str) -> dt.date:
    """Run date as a plain date; a time of day is dropped, so a run at noon covers whole days."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value[:10])


def day(col: Column | str) -> Column:
    return F.to_date(col)


def day_gap(start: Column, end: Column) -> Column:
    """Midnights passed from start to end (negative when end is earlier)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def week_number(col: Column) -> Column:
    return F.floor(F.datediff(F.to_date(col), F.lit(_FIRST_SUNDAY)) / 7).cast("int")


def week_gap(start: Column, end: Column) -> Column:
    """Sundays passed from start to end: Saturday to the next day is one week."""
    return week_number(end) - week_number(start)


def month_gap(start: Column, end: Column) -> Column:
    """First-of-months passed from start to end."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def weekdays_between(start: Column, end: Column) -> Column:
    """Days counted inclusively, less two per Sunday passed. Approximate when an end is at a weekend."""
    return day_gap(start, end) + 1 - week_gap(start, end) * 2


def plus_days(col: Column, n: int) -> Column:
    """Adds days and keeps the time of day."""
    return F.timestamp_add("DAY", F.lit(n), col)


def plus_weeks(col: Column, n: int) -> Column:
    return F.timestamp_add("WEEK", F.lit(n), col)


def plus_months(col: Column, n: int) -> Column:
    """Adds months, clips to the month's last day, keeps the time of day."""
    return F.timestamp_add("MONTH", F.lit(n), col)


def dmy(col: Column) -> Column:
    """Date as dd/MM/yyyy text."""
    return F.date_format(col, "dd/MM/yyyy")


def month_start(d: dt.date, shift: int = 0) -> dt.date:
    """First day of the month `shift` months away from d."""
    months = d.year * 12 + d.month - 1 + shift
    return dt.date(months // 12, months % 12 + 1, 1)


def is_sunday(col: Column) -> Column:
    return F.dayofweek(col) == 1
