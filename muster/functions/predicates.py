"""Conditions with explicit NULL behaviour."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs_or_null(col: Column | str, value) -> Column:
    """True for every value but `value`; NULL counts as different."""
    c = F.col(col) if isinstance(col, str) else col
    return ~c.eqNullSafe(F.lit(value))


def never(cond: Column) -> Column:
    """True unless the condition holds; an unknown condition does not hold."""
    return ~F.coalesce(cond, F.lit(False))


def holds(cond: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(cond, F.lit(False))


def valid_at(start: Column, end: Column, as_of: dt.date, planned_start: Column | None = None) -> Column:
    """Active on the day: not ended, and started.

    A missing end never ends. With `planned_start`, a row that has no start counts as started once its
    planned start has come, or when it has none.
    """
    today = F.lit(as_of)
    open_end = end.isNull() | (F.to_date(end) >= today)
    started = F.to_date(start) <= today
    if planned_start is not None:
        started = started | (start.isNull() & (planned_start.isNull() | (F.to_date(planned_start) <= today)))
    return open_end & started


def later_of(a: Column, b: Column) -> Column:
    """a when it is later, else b: a missing a gives b, and a missing b stays missing (unlike greatest)."""
    return F.when(a > b, a).otherwise(b)
