"""Row filters. Date bounds are half-open ranges on the bare column, so they reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, predicates


def between_days(col: Column | str, first: dt.date, last: dt.date) -> Column:
    """Whole days first..last, both included, whatever the time of day."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(first)) & (c < F.lit(last + dt.timedelta(days=1)))


def within_days(df: DataFrame, col: str, as_of: dt.date, before: int = 0, after: int = 0) -> DataFrame:
    """Rows dated from `before` days before the run date to `after` days after it."""
    d = dates.as_date(as_of)
    return df.where(between_days(col, d - dt.timedelta(days=before), d + dt.timedelta(days=after)))


def in_period(df: DataFrame, col: str, as_of: dt.date, kind: str, since: dt.date | None = None) -> DataFrame:
    """Rows in a calendar period around the run date.

    `kind` is one of: "month" (the run date's whole month), "previous_month", "year_on" (from 1 January,
    open end), "since" (from `since`, open end), "since_to_previous_month" (from `since` up to and
    including midnight on the first day of last month).
    """
    d = dates.as_date(as_of)
    c = F.col(col)
    if kind == "month":
        return df.where((c >= F.lit(dates.month_start(d))) & (c < F.lit(dates.month_start(d, 1))))
    if kind == "previous_month":
        return df.where((c >= F.lit(dates.month_start(d, -1))) & (c < F.lit(dates.month_start(d))))
    if kind == "year_on":
        return df.where(c >= F.lit(dt.date(d.year, 1, 1)))
    if kind == "since":
        return df.where(c >= F.lit(since))
    if kind == "since_to_previous_month":
        return df.where((c >= F.lit(since)) & (c <= F.lit(dates.month_start(d, -1))))
    raise ValueError(f"unknown period {kind!r}")


def not_equal_or_null(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(predicates.differs_or_null(col, value))


def exclude_when(df: DataFrame, cond: Column) -> DataFrame:
    """Drops rows where the condition holds; rows where it is unknown stay."""
    return df.where(predicates.never(cond))


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest day.

    The day is a scalar subquery, computed once. The filter is a half-open range on the bare column, so
    a date-partitioned table is pruned to one partition by the subquery's result.
    """
    newest = df.agg(F.to_date(F.max(date_col)).alias("newest")).scalar()
    following = df.agg(F.date_add(F.to_date(F.max(date_col)), 1).alias("following")).scalar()
    return df.where((F.col(date_col) >= newest) & (F.col(date_col) < following))


def remap(df: DataFrame, key: str, codes: Iterable, values: Mapping[str, object]) -> DataFrame:
    """Where the key is one of `codes`, overwrites the given columns; the test sees the old key."""
    hit = F.col(key).isin(list(codes))
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})
