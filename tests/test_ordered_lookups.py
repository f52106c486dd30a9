"""Lookups and ranks against brute force, with wide and with narrow slices and every kind of order column."""

import datetime as dt
import os
import random
import re

import pytest
from helpers import plan, rows, ts
from pyspark.sql import functions as F

from muster.operators import lookups, ordered, ranks

WIDTHS = [None, 7]


def moments(spark, n, seed, keys=4, kinds=("a", "b"), spread=900):
    """Rows (id, k, at, kind): one key holds a third, times collide."""
    rnd = random.Random(seed)
    start = dt.datetime(2022, 1, 1)
    out = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(keys)}"
        if i % 11 == 0:
            k = None
        at = start + dt.timedelta(seconds=20 * rnd.randrange(spread)) if i % 13 else None
        out.append((i, k, at, rnd.choice(kinds)))
    return out, spark.createDataFrame(out, "id int, k string, at timestamp_ntz, kind string")


def low(x):
    return (x is not None, x)


@pytest.mark.parametrize("width", WIDTHS)
def test_asof_matches_brute_force(spark, width):
    left, ldf = moments(spark, 150, 1)
    right, rdf = moments(spark, 150, 2)
    got = lookups.asof_lookup(ldf, rdf, "k", "at", "at", {"r": "id"}, tie="id", width=width)
    want = []
    for i, k, at, _ in left:
        hits = [(t, j) for j, kk, t, _ in right if k is not None and kk == k and at and t and t <= at]
        want.append((i, max(hits)[1] if hits else None))
    assert rows(got, "id", "r") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_a_range_takes_few_rows(spark):
    """The two ends and few blocks of whole slots, which tile the range; a block size that no range needs is not probed."""
    spans = spark.createDataFrame([(1, 700_003, 700_093), (2, 700_003, 703_500), (3, 700_010, 700_010)], "r int, _from int, _to int")
    pieces = {(x.r, x._from, x._to) for x in lookups._with_pieces(spans).collect()}
    assert pieces == {(1, 700_003, 700_031), (1, 700_032, 700_093), (2, 700_003, 700_031), (2, 703_488, 703_500), (3, 700_010, 700_010)}
    inner = spans.selectExpr("r", "(_from >> 6) + 1 AS _from", "(_to >> 6) - 1 AS _to").where("_from <= _to")
    blocks = [(x._slot << 4 * x._level, (x._slot + 1) << 4 * x._level) for x in lookups._with_blocks(inner, 2).collect()]
    assert sorted(s for a, b in blocks for s in range(a, b)) == [*range(10_938, 10_992)] and len(blocks) < 54
    assert [lookups._levels_needed(n) for n in (None, 0, 1, 15, 16, 4096)] == [0, 0, 1, 1, 2, 4]


def test_asof_by_day_settles_ties_by_highest(spark):
    left = spark.createDataFrame([(1, "a", ts("2022-01-02T08:00:00"))], "id int, k string, at timestamp_ntz")
    right = spark.createDataFrame(
        [(1, "a", ts("2022-01-02T20:00:00")), (2, "a", ts("2022-01-02T09:00:00")), (3, "a", ts("2022-01-03"))],
        "r int, k string, at timestamp_ntz",
    )
    got = lookups.asof_lookup(left, right, "k", "at", "at", {"r": "r"}, tie="r", by_day=True)
    assert rows(got, "id", "r") == [(1, 2)]


def test_range_lookup_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2020, 1, 1)
    spans = []
    for j in range(80):
        a = base + dt.timedelta(days=rnd.randrange(900))
        b = rnd.choice([a, a + dt.timedelta(days=rnd.randrange(600)), dt.date(9999, 12, 31), a - dt.timedelta(days=1)])
        spans.append((j, f"k{j % 3}", dt.datetime.combine(a, dt.time(rnd.choice([0, 0, 9]))), dt.datetime.combine(b, dt.time())))
    asked = [(i, f"k{i % 4}", dt.datetime.combine(base + dt.timedelta(days=rnd.randrange(1200)), dt.time(5))) for i in range(120)]
    asked += [(998, "k0", dt.datetime(1, 1, 1)), (999, "k0", dt.datetime(9999, 12, 31))]
    left = spark.createDataFrame(asked, "id int, k string, at timestamp_ntz")
    right = spark.createDataFrame(spans, "r int, k string, a timestamp_ntz, b timestamp_ntz")
    got = lookups.range_lookup(left, right, "k", "at", F.col("a"), F.col("b"), F.col("a"), {"hit": "r"}, tie="r")
    want = []
    for i, k, at in asked:
        day = dt.datetime.combine(at.date(), dt.time())
        hits = [(a, j) for j, kk, a, b in spans if kk == k and a <= day <= b]
        want.append((i, max(hits)[1] if hits else None))
    assert rows(got, "id", "hit") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_neighbour_matches_brute_force(spark, width, forward, descending):
    data, df = moments(spark, 200, 4)
    got = ordered.neighbour(df, ["k"], ["at", "id"], {"n": "id"}, forward=forward, descending=descending, width=width)
    want = []
    for k in {r[1] for r in data}:
        line = sorted((r for r in data if r[1] == k), key=lambda r: (low(r[2]), r[0]), reverse=descending)
        for p, r in enumerate(line):
            q = p + (1 if forward else -1)
            want.append((r[0], line[q][0] if 0 <= q < len(line) else None))
    assert rows(got, "id", "n") == sorted(want, key=repr)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_match_brute_force(spark, width, descending):
    data, df = moments(spark, 200, 5, spread=40)
    dense = ranks.rank_within(df, ["k"], "at", "rk", descending=descending, width=width)
    number = ranks.number_within(df, ["k"], ["at", "id"], "rn", descending=descending, width=width)
    want_dense, want_number = [], []
    for k in {r[1] for r in data}:
        mine = [r for r in data if r[1] == k]
        values = sorted({low(r[2]) for r in mine}, reverse=descending)
        want_dense += [(r[0], values.index(low(r[2])) + 1) for r in mine]
        line = sorted(mine, key=lambda r: (low(r[2]), r[0]), reverse=descending)
        want_number += [(r[0], p + 1) for p, r in enumerate(line)]
    assert rows(dense, "id", "rk") == sorted(want_dense, key=repr)
    assert rows(number, "id", "rn") == sorted(want_number, key=repr)


def test_latest_and_earliest_keep_ties_and_nulls(spark):
    data = [(1, "a", ts("2022-01-01")), (2, "a", ts("2022-01-02")), (3, "a", ts("2022-01-02")), (4, "b", None),
            (5, "c", None), (6, "c", ts("2022-01-01")), (7, None, ts("2022-01-05"))]
    df = spark.createDataFrame(data, "id int, k string, at timestamp_ntz")
    assert rows(ranks.latest_rows(df, ["k"], "at"), "id") == [(2,), (3,), (4,), (6,), (7,)]
    assert rows(ranks.latest_rows(df, ["k"], "at", earliest=True), "id") == [(1,), (4,), (5,), (7,)]


def test_first_row_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    out = ranks.first_row(df, ["k"], F.col("id").desc())
    assert rows(out) == [(2, "a"), (3, "b")]
    assert "WindowGroupLimit" in plan(out)


def test_next_event_multiplies_ties(spark):
    df = spark.createDataFrame(
        [(1, "p", 10), (2, "p", 10), (3, "p", 20), (4, "p", 20), (5, "p", 30), (6, "q", 1)], "id int, k string, at int"
    )
    got = lookups.next_event(df, "k", "at", {"next_id": "id"})
    assert rows(got, "id", "next_id") == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 5), (4, 5)]


@pytest.mark.parametrize("width", [None, 1440])
def test_contiguous_predecessor(spark, width):
    data = [
        (1, "p", "v1", ts("2022-01-01"), ts("2022-01-10")),
        (2, "p", "v1", ts("2022-01-12"), ts("2022-01-20")),  # two days after 1
        (3, "p", "v2", ts("2022-01-21"), ts("2022-01-25")),  # other vessel
        (4, "p", "v2", ts("2022-01-28"), None),              # three days after 3
        (5, "q", "v1", ts("2022-01-01"), None),
    ]
    df = spark.createDataFrame(data, "id int, k string, v string, a timestamp_ntz, b timestamp_ntz")
    got = lookups.contiguous_predecessor(df, "k", ["a", "id"], "v", "a", F.col("b"), 2, {"before": "id"}, width=width)
    assert rows(got, "id", "before") == [(1, None), (2, 1), (3, None), (4, None), (5, None)]


def test_next_status_is_on_a_later_day_and_keeps_ties(spark):
    plans = spark.createDataFrame([
        ("p", "s", ts("2022-01-01T08:00:00"), "Approved"), ("p", "s", ts("2022-01-01T20:00:00"), "Released"),
        ("p", "s", ts("2022-01-03"), "Ready"), ("p", "s", ts("2022-01-03"), "Cancelled"), ("p", "s", ts("2022-01-04"), "Released"),
        ("q", "s", ts("2022-01-01"), "Approved"),
    ], "k string, s string, at timestamp_ntz, status string")
    anchors = plans.where("status = 'Approved'").select("k", "s", F.col("at").alias("since"))
    got = lookups.next_status_after(plans, anchors, ["k", "s"], "at", "status", "since", "next")
    assert rows(got) == [("p", "s", "Cancelled"), ("p", "s", "Ready")]


def test_history_ranks_and_movers(spark):
    df = spark.createDataFrame([("p", "A", 1), ("p", "B", 2), ("p", "A", 3), ("q", "A", 1)], "k string, g string, d int")
    assert rows(ranks.rank_history(df, "k", "g", "d")) == [
        ("p", "A", 1, 2, 3, 2), ("p", "A", 3, 1, 1, 2), ("p", "B", 2, 1, 2, 1), ("q", "A", 1, 1, 1, 1),
    ]
    assert rows(ranks.multi_group_entities(df, "k", "g")) == [("p",)]


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double", "decimal(20,2)", "boolean"])
@pytest.mark.parametrize("descending", [False, True])
def test_any_order_column_is_sliced(spark, kind, descending):
    rnd = random.Random(9)
    data = [(i, "hot" if i % 3 else "k", None if i % 17 == 0 else rnd.randrange(400)) for i in range(300)]
    df = spark.createDataFrame(data, "id int, k string, v int").withColumn("at", F.col("v").cast(kind))
    values = {r.id: r.at for r in df.collect()}
    got = ranks.number_within(df, ["k"], ["at", "id"], "rn", descending=descending)
    near = ordered.neighbour(df, ["k"], ["at", "id"], {"n": "id"}, descending=descending)
    number, before = [], []
    for k in ("hot", "k"):
        line = sorted((i for i, kk, _ in data if kk == k), key=lambda i: (low(values[i]) if values[i] is not None else (False,), i), reverse=descending)
        number += [(i, p + 1) for p, i in enumerate(line)]
        before += [(i, line[p - 1] if p else None) for p, i in enumerate(line)]
    assert rows(got, "id", "rn") == sorted(number, key=repr)
    assert rows(near, "id", "n") == sorted(before, key=repr)
    slices = df.select(ordered.bucket(df, "at").alias("s")).distinct().count()
    assert slices <= ordered.SLICES + 2 and (slices > 20 or kind == "boolean")


@pytest.mark.parametrize("width", [None, 1])
def test_instants_stay_in_order_when_clocks_go_back(spark, width):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = [1636264200 + 1200 * i for i in range(12)]  # 2021-11-07, 01:50 to 04:30, with 01:00 to 02:00 twice
        df = spark.createDataFrame([(i, "k", s) for i, s in enumerate(seconds)], "id int, k string, s bigint").withColumn("at", F.timestamp_seconds("s"))
        got = ordered.running_number(df, ["k"], ["at"], "rn", width=width)
        assert rows(got, "id", "rn") == sorted(((i, i + 1) for i in range(12)), key=repr)
        near = ordered.neighbour(df, ["k"], ["at"], {"n": "id"}, width=width)
        assert rows(near, "id", "n") == sorted(((i, i - 1 if i else None) for i in range(12)), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates_before_the_epoch(spark):
    days = [dt.date(1969, 1, 1) + dt.timedelta(days=7 * i) for i in range(120)]
    df = spark.createDataFrame([(i, "k", d) for i, d in enumerate(days)], "id int, k string, at date")
    assert rows(ordered.running_number(df, ["k"], ["at"], "rn"), "id", "rn") == sorted(((i, i + 1) for i in range(120)), key=repr)


def test_rank_history_of_a_hot_person_in_one_exchange(spark):
    """Half of all rows are one person's; dates and groups repeat and may be NULL."""
    rnd = random.Random(12)
    data = [(i, "hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice(["g", "h", "i", None]), rnd.choice([None, *range(0, 90, 3)])) for i in range(400)]
    data = [(i, p, g, None if d is None else ts("2024-01-01") + dt.timedelta(hours=7 * d)) for i, p, g, d in data]
    df = spark.createDataFrame(data, "id int, k string, g string, d timestamp_ntz")
    out = ranks.rank_history(df, "k", "g", "d")
    dense = lambda own, values: 1 + len({v for v in values if v is not None and (own is None or v > own)})
    want = []
    for i, p, g, d in data:
        same = [r for r in data if r[1] == p]
        want.append((i, dense(d, [r[3] for r in same if r[2] == g]), dense(d, [r[3] for r in same]), dense(g, [r[2] for r in same])))
    assert rows(out, "id", "rank_in_group", "rank_by_date", "rank_of_group") == sorted(want, key=repr)
    assert len(re.findall(r"Exchange hashpartitioning", plan(ranks.rank_history(df, "k", "g", "d")))) <= 6


def test_shared_sets_are_written_once_and_removed(spark):
    from muster.sources.tables import RunScope, shared

    calls = []
    scope = RunScope({"t": spark.range(5)})
    build = lambda: calls.append(1) or scope["t"].where("id > 2")
    assert [shared(scope, "few", build).count() for _ in range(3)] == [2, 2, 2] and len(calls) == 1
    folder = scope._folder
    assert os.path.isdir(f"{folder}/few")
    scope.close()
    assert not os.path.exists(folder) and RunScope.of(scope) is scope
    assert shared({"t": 1}, "few", lambda: "built") == "built"
