"""Aggregates with the NULL and truncation rules the scorecards rely on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_status(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column], item: str) -> DataFrame:
    """Per key, the number of non-null items under each condition, in one pass."""
    return df.groupBy(*keys).agg(
        *[F.count(F.when(cond, F.col(item))).alias(name) for name, cond in counts.items()]
    )


def sum_of_sums(*cols: str) -> Column:
    """Total of several columns' sums; NULL when any of them has no value."""
    total = F.sum(cols[0])
    for c in cols[1:]:
        total = total + F.sum(c)
    return total


def int_avg(col: str | Column) -> Column:
    """Mean of whole numbers cut toward zero, exact over all of bigint; NULL when there is none."""
    return whole_quotient(F.sum(col), F.count(col))


def whole_quotient(total: Column, n: Column) -> Column:
    """total / n cut toward zero without going through a double; NULL for n = 0."""
    return F.when(n != 0, F.call_function("div", total.cast("bigint"), n.cast("bigint")))
