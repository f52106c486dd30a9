from helpers import plan, rows
from pyspark.sql import functions as F

from muster.operators.aggregates import int_avg
from muster.operators.rules import Rule, apply_rules, where_after_rules
from muster.operators.scorecard import COUNT, INT_AVG, SUM, Kpi, scorecard


def test_scorecard_defaults_and_merging(spark):
    groups = spark.createDataFrame([("g1",), ("g2",), ("UNKNOWN",)], "group_id string")
    src = spark.createDataFrame(
        [("g1", "p1", 1, "x"), ("g1", "p1", 2, "y"), ("g1", "p2", None, "x"), ("g2", "p3", -3, "y"), ("g2", "p4", 0, None), (None, "p5", 9, "x")],
        "g string, p string, n int, s string",
    )
    card = scorecard(groups, [
        Kpi("people", src, "g", "p"), Kpi("x_people", src, "g", "p", where=F.col("s") == "x"),
        Kpi("rows", src, "g", "p", COUNT), Kpi("numbers", src, "g", "n", COUNT), Kpi("total", src, "g", "n", SUM),
        Kpi("mean", src, "g", "n", INT_AVG), Kpi("labels", src, "g", "s"),
    ], constants=["reserved"])
    assert rows(card) == [
        ("UNKNOWN", 0, 0, 0, 0, None, None, 0, None), ("g1", 2, 2, 3, 2, 3, 1, 2, None), ("g2", 2, 0, 2, 2, -3, -1, 1, None),
    ]
    assert "Expand" not in plan(card)


def test_scorecard_weighted_mean(spark):
    groups = spark.createDataFrame([("g",)], "group_id string")
    src = spark.createDataFrame([("g", 10, 1), ("g", 20, 4), ("g", None, 5)], "g string, n int, w int")
    card = scorecard(groups, [Kpi("mean", src, "g", "n", INT_AVG, weight="w")])
    assert rows(card) == [("g", 18)]


def base(spark):
    return spark.createDataFrame([(1, "Failing", "old"), (2, "Fine", "old"), (3, None, "old")], "id int, status string, note string")


def test_all_values_of_a_rule_read_the_old_row(spark):
    failing = F.col("status") == "Failing"
    sets = {"status": F.lit("Warning"), "note": F.when(failing, "was failing").otherwise("lost")}
    out = apply_rules(base(spark), [Rule("ease", failing, sets)])
    assert rows(out) == [(1, "Warning", "was failing"), (2, "Fine", "old"), (3, None, "old")]


def test_rule_order_matters(spark):
    ease = Rule("ease", F.col("status") == "Failing", {"status": F.lit("Warning")})
    mark = Rule("mark", F.col("status") == "Warning", {"note": F.lit("marked")})
    assert rows(apply_rules(base(spark), [ease, mark]), "note") != rows(apply_rules(base(spark), [mark, ease]), "note")


def test_filter_after_many_rules_stays_small(spark):
    note = F.col("note")
    grow = [Rule(str(i), note.ilike("%o%"), {"note": F.when(note.ilike("%l%"), note).otherwise(F.concat(note, note))}) for i in range(15)]
    out = where_after_rules(apply_rules(base(spark), grow), note.isNull() | ~note.ilike("x%"))
    assert out.count() == 3 and len(plan(out)) < 200_000


def test_whole_means_are_exact_beyond_doubles(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([("a", big), ("b", -7), ("b", 0), ("c", None)], "g string, v bigint")
    got = df.groupBy("g").agg(int_avg("v").alias("m"))
    assert rows(got) == [("a", big), ("b", -3), ("c", None)]
    card = scorecard(df.select(F.col("g").alias("group_id")).distinct(), [Kpi("m", df, "g", "v", INT_AVG)])
    assert rows(card, "group_id", "m") == [("a", big), ("b", -3), ("c", None)]
