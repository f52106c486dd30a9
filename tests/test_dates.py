import datetime as dt

import pytest
from helpers import ts
from pyspark.sql import functions as F

from muster.functions import dates, predicates, text


def one(spark, col, **values):
    kinds = {dt.datetime: "timestamp_ntz", dt.date: "date", str: "string", int: "int", type(None): "timestamp_ntz"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("start,end,weeks", [
    ("2022-01-15", "2022-01-16", 1),  # Saturday to Sunday
    ("2022-01-16", "2022-01-22", 0),  # Sunday to Saturday
    ("2022-01-16", "2022-01-15", -1),
    ("2022-01-14T23:59:00", "2022-01-30T00:00:00", 3),
])
def test_week_gap_counts_sundays(spark, start, end, weeks):
    assert one(spark, dates.week_gap(F.col("a"), F.col("b")), a=ts(start), b=ts(end)) == weeks


@pytest.mark.parametrize("start,end,days", [
    ("2022-01-10", "2022-01-14", 5), ("2022-01-14", "2022-01-17", 2), ("2022-01-17", "2022-01-14", 0),
])
def test_weekdays_between(spark, start, end, days):
    assert one(spark, dates.weekdays_between(F.col("a"), F.col("b")), a=ts(start), b=ts(end)) == days


def test_day_gap_counts_midnights(spark):
    a, b = ts("2022-01-01T23:59:00"), ts("2022-01-02T00:01:00")
    assert one(spark, dates.day_gap(F.col("a"), F.col("b")), a=a, b=b) == 1


def test_month_gap_counts_firsts(spark):
    assert one(spark, dates.month_gap(F.col("a"), F.col("b")), a=ts("2021-12-31"), b=ts("2022-01-01")) == 1


def test_plus_months_clips_and_keeps_time(spark):
    assert one(spark, dates.plus_months(F.col("a"), 1), a=ts("2022-01-31T10:30:00")) == ts("2022-02-28T10:30:00")


def test_month_start_over_january():
    assert dates.month_start(dt.date(2022, 1, 15), -1) == dt.date(2021, 12, 1)
    assert dates.month_start(dt.date(2022, 12, 31), 1) == dt.date(2023, 1, 1)


def test_run_date_drops_time():
    assert dates.as_date(dt.datetime(2022, 1, 15, 13)) == dt.date(2022, 1, 15)
    assert dates.as_date("2022-01-15T13:00") == dt.date(2022, 1, 15)


def test_text_date_and_null_concatenation(spark):
    assert one(spark, dates.dmy(F.col("a")), a=ts("2022-01-05T10:00:00")) == "05/01/2022"
    assert one(spark, text.joined("until ", dates.dmy(F.col("a"))), a=None) is None


def test_text_ignores_case(spark):
    assert one(spark, text.same_text("a", "ACTIVE"), a="Active")
    assert one(spark, text.like("a", "%waiver%"), a="By Waiver 7")


def test_later_of_null_rule(spark):
    later = predicates.later_of(F.col("a"), F.col("b"))
    assert one(spark, later, a=None, b=ts("2022-01-01")) == ts("2022-01-01")
    assert one(spark, later, a=ts("2022-01-01"), b=None) is None
    assert one(spark, later, a=ts("2022-01-02"), b=ts("2022-01-01")) == ts("2022-01-02")


@pytest.mark.parametrize("start,end,planned,valid", [
    ("2022-01-15", None, None, True), ("2022-01-16", None, None, False), ("2022-01-01", "2022-01-15", None, True),
    ("2022-01-01", "2022-01-14", None, False), (None, None, None, True), (None, None, "2022-01-16", False),
    (None, None, "2022-01-10", True),
])
def test_valid_at(spark, start, end, planned, valid):
    day = dt.date(2022, 1, 15)
    col = predicates.valid_at(F.col("a"), F.col("b"), day, F.col("c"))
    assert bool(one(spark, col, a=ts(start), b=ts(end), c=ts(planned))) is valid
