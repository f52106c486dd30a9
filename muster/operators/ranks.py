"""Ranks, latest rows and history ranks.

"Keep rank 1" never runs as a full window: the best order value comes from a hash aggregate (combined
before the shuffle) and is joined back, so the ties of a hot key need not meet in one task. Full ranks
are computed over the distinct order values only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.operators import ordered


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    *,
    descending: bool = True,
    width: int | None = None,
) -> DataFrame:
    """Dense rank per key: equal order values share a rank and ranks have no gaps."""
    values = df.select(*keys, order).distinct()
    ranked = ordered.running_number(
        values, keys, [order], name, descending=descending, width=width
    )
    return _join_back(df, ranked, [*keys, order], [name])


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    *,
    descending: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Row number per key; `order` ends in a unique tie-breaker."""
    return ordered.running_number(
        df, keys, order, name, descending=descending, width=width
    )


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, *, earliest: bool = False) -> DataFrame:
    """Rows holding their key's latest (or earliest) order value, ties kept.

    NULL sorts lowest: it is the latest only when a key has nothing else, and the earliest whenever present.
    """
    if earliest:
        has_null = F.count(F.lit(1)) > F.count(order)
        best = F.when(~has_null, F.min(order))
    else:
        best = F.max(order)
    top = df.groupBy(*keys).agg(best.alias("_best"))
    return _semi_join_same(df, top.withColumnRenamed("_best", order), [*keys, order])


def first_row(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in `order` (end it in a unique column).

    Spark keeps one row per key in every map task before shuffling (WindowGroupLimit), so a hot key sends
    at most one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def one_row_guard(df: DataFrame, number_col: str = "row_number") -> DataFrame:
    """Keeps rows an upstream view numbered 1."""
    return df.where(F.col(number_col) == 1)


def rank_history(df: DataFrame, person: str, group: str, date: str, *, width: int | None = None) -> DataFrame:
    """Adds three dense ranks: rank_in_group (newest date first within person and group), rank_by_date
    (newest first within person) and rank_of_group (highest group code first within person).

    One exchange deals the rows by person and slice of the date, where all local ranks are taken. Its summary, a row per person,
    slice and group, is dealt by person and gives what newer slices add, and the ranks of the groups.
    """
    # Struct keys compare NULL as equal, like PARTITION BY, and still join by hash.
    rows = df.withColumns({"_p": F.struct(person), "_g": F.struct(group), "_s": ordered.bucket(df, date, width)})
    newest = F.col(date).desc_nulls_last()
    local = rows.repartition("_p", "_s").withColumns({
        "_in_group": F.dense_rank().over(Window.partitionBy("_p", "_s", "_g").orderBy(newest)),
        "_by_date": F.dense_rank().over(Window.partitionBy("_p", "_s").orderBy(newest)),
    })
    counts = local.groupBy("_p", "_s", "_g").agg(F.max("_in_group").alias("_n_group"), F.max("_by_date").alias("_n_date"))
    slices, later = F.col("_s").desc(), (Window.unboundedPreceding, -1)
    counts = counts.repartition("_p").withColumns({
        "_all": F.max("_n_date").over(Window.partitionBy("_p", "_s")),
        "_first": F.row_number().over(Window.partitionBy("_p", "_s").orderBy("_g")) == 1,
    }).withColumns({
        "_newer_in_group": F.sum("_n_group").over(Window.partitionBy("_p", "_g").orderBy(slices).rowsBetween(*later)),
        "_newer": F.sum(F.when(F.col("_first"), F.col("_all"))).over(Window.partitionBy("_p").orderBy(slices, "_g").rowsBetween(*later)),
        "rank_of_group": F.dense_rank().over(Window.partitionBy("_p").orderBy(F.col("_g").desc())).cast("bigint"),
    })
    # What stands before a slice's first row are the newer slices; the first row itself counts from the second on.
    before = F.coalesce(F.col("_newer"), F.lit(0)) - F.when(F.col("_first"), 0).otherwise(F.col("_all"))
    facts = counts.select("_p", "_s", "_g", "_newer_in_group", before.alias("_before"), "rank_of_group")
    both = local.join(facts, ["_p", "_s", "_g"])
    return both.select(
        *df.columns, (F.col("_in_group") + F.coalesce("_newer_in_group", F.lit(0))).cast("bigint").alias("rank_in_group"),
        (F.col("_by_date") + F.col("_before")).cast("bigint").alias("rank_by_date"), "rank_of_group",
    )


def multi_group_entities(df: DataFrame, person: str, group: str) -> DataFrame:
    """Persons seen in more than one group. Two extremes that differ say so without a distinct count."""
    return (
        df.groupBy(person)
        .agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select(person)
    )


def _join_back(df: DataFrame, facts: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    right = facts.select(*[F.col(c).alias(f"_r_{c}") for c in on], *take)
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return df.join(right, cond, "left").select(*df.columns, *take)


def _semi_join_same(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    right = keys.select(*[F.col(c).alias(f"_r_{c}") for c in on])
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return df.join(right, cond, "left_semi")
