import datetime as dt

from helpers import plan, rows, ts
from pyspark.sql import functions as F

from muster.operators import aggregates, filters, joins

DAY = dt.date(2022, 1, 15)


def stamps(spark, *texts):
    return spark.createDataFrame([(t, ts(t)) for t in texts], "name string, at timestamp_ntz")


def test_within_days_is_31_whole_days(spark):
    df = stamps(spark, "2021-12-15T23:59:59", "2021-12-16", "2022-01-15T23:59:59", "2022-01-16")
    kept = filters.within_days(df, "at", dt.datetime(2022, 1, 15, 12), before=30)
    assert rows(kept, "name") == [("2021-12-16",), ("2022-01-15T23:59:59",)]


def test_previous_month_in_january(spark):
    df = stamps(spark, "2021-11-30T23:59:59", "2021-12-01", "2021-12-31T23:59:59", "2022-01-01")
    kept = filters.in_period(df, "at", DAY, "previous_month")
    assert rows(kept, "name") == [("2021-12-01",), ("2021-12-31T23:59:59",)]


def test_since_to_previous_month_ends_at_midnight(spark):
    df = stamps(spark, "2016-12-31", "2017-01-01", "2021-12-01", "2021-12-01T00:00:01")
    kept = filters.in_period(df, "at", DAY, "since_to_previous_month", since=dt.date(2017, 1, 1))
    assert rows(kept, "name") == [("2017-01-01",), ("2021-12-01",)]


def test_unknown_conditions_keep_or_drop(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, None)], "id int, status int")
    assert rows(filters.not_equal_or_null(df, "status", 3), "id") == [(2,), (3,)]
    assert rows(filters.exclude_when(df, F.col("status") == 3), "id") == [(2,), (3,)]
    assert rows(df.where(~F.col("status").isin(3)), "id") == [(2,)]


def test_latest_snapshot_takes_the_whole_day(spark):
    df = stamps(spark, "2022-01-14T10:00:00", "2022-01-15T01:00:00", "2022-01-15T09:00:00")
    kept = filters.latest_snapshot(df, "at")
    assert rows(kept, "name") == [("2022-01-15T01:00:00",), ("2022-01-15T09:00:00",)]


def test_remap_tests_the_old_key(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "k string, label string")
    out = filters.remap(df, "k", ["a"], {"k": "b", "label": "merged"})
    assert rows(out) == rows(spark.createDataFrame([("b", "merged"), ("b", "y"), (None, "z")], "k string, label string"))


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(1,)], "k int")
    holed = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.exclude_not_in(left, some, "k")) == [(2,)]
    assert rows(joins.exclude_not_in(left, holed, "k")) == []
    assert rows(joins.exclude_not_in(left, some.where("k > 5"), "k")) == [(1,), (2,), (None,)]
    assert rows(joins.exclude_matching(left, holed, "k")) == [(2,), (None,)]
    assert "NestedLoop" not in plan(joins.exclude_not_in(left, some, "k"))


def test_semi_join_never_multiplies(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.keep_matching(left, right, "k")) == [(1,)]


def test_filtered_left_join_keeps_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "y"), (2, "n")], "k int, ok string")
    assert rows(joins.join_filtered(left, right, "k", F.col("ok") == "y")) == [(1, "y"), (2, None)]


def test_roles_take_first_and_fan_out(spark):
    left = spark.createDataFrame([("v1", "VMS"), ("v2", "VMS"), ("v3", "Other")], "v string, kind string")
    marks = spark.createDataFrame(
        [("v1", "VMS", "own"), ("v1", "ALL", "all"), ("v2", "ALL", "a"), ("v2", "ALL", "b"), ("v3", None, "any")],
        "v string, category string, remark string",
    )
    roles = {"own": F.lit(True), "all": F.col("category") == "ALL"}
    out = joins.coalesce_roles(left, marks, "v", roles, ["category", "remark"], extra_on={"own": "kind"})
    assert rows(out, "v", "category", "remark") == [
        ("v1", "VMS", "own"), ("v2", "ALL", "a"), ("v2", "ALL", "b"), ("v3", None, "any"),
    ]


def test_join_on_date_is_a_hash_join(spark):
    left = stamps(spark, "2022-01-15T10:00:00", "2022-01-16T10:00:00")
    right = spark.createDataFrame([(DAY, 1)], "date date, date_key int")
    out = joins.join_on_date(left, right, "at", "date")
    assert rows(out, "name", "date_key") == [("2022-01-15T10:00:00", 1), ("2022-01-16T10:00:00", None)]
    assert "NestedLoop" not in plan(out)


def test_presence_and_sentinel(spark):
    people = spark.createDataFrame([("a",), ("b",)], "k string")
    marked = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(joins.flag_presence(people, marked, "k", "s", "Signed", "Missing")) == [("a", "Signed"), ("b", "Missing")]
    assert rows(joins.union_sentinel(marked, {"k": "UNKNOWN"})) == [("UNKNOWN",), ("a",)]


def test_any_link_matches_once(spark):
    people = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    links = [spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("a",), ("b",)], "k string")]
    assert rows(joins.any_link_match(people, "k", links)) == [("a",), ("b",)]


def test_sums_and_averages(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, None), ("b", 3, None), ("c", -3, 1), ("c", 0, 1)], "k string, x int, y int")
    out = df.groupBy("k").agg(aggregates.sum_of_sums("x", "y").alias("t"), aggregates.int_avg("x").alias("m"))
    assert rows(out) == [("a", 5, 1), ("b", None, 3), ("c", -1, -1)]
    counts = aggregates.count_by_status(df, ["k"], {"two": F.col("y") == 2, "other": F.col("y") != 2}, "x")
    assert rows(counts) == [("a", 1, 0), ("b", 0, 0), ("c", 0, 2)]
