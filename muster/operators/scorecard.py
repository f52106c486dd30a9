"""Scorecards: one row per group, one column per indicator.

Indicators that read the same source by the same key and count the same id become one aggregate of two
steps: first per (group, id) - combined before the shuffle, and spread over tasks by id, so one huge
group is no bottleneck - and then per group over those rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.operators.aggregates import whole_quotient

COUNT_DISTINCT, COUNT, SUM, INT_AVG = "count_distinct", "count", "sum", "int_avg"


@dataclass(frozen=True)
class Kpi:
    """One indicator.

    `how` is "count_distinct" or "count" of `value` (0 for a group without rows), "sum" of `value` (NULL
    without rows) or "int_avg" (whole mean, NULL without rows; `weight` counts a row that many times). `group_key` is the group column that
    `key` of the source equals. Only rows satisfying `where` take part.
    """

    name: str
    source: DataFrame
    key: str
    value: str
    how: str = COUNT_DISTINCT
    where: Column | None = None
    group_key: str = "group_id"
    weight: str | None = None


def scorecard(groups: DataFrame, kpis: Sequence[Kpi], constants: Sequence[str] = ()) -> DataFrame:
    """Groups with every indicator, in the order given; `constants` are reserved NULL columns at the end."""
    out = groups
    families: dict[tuple, list[Kpi]] = {}
    for kpi in kpis:
        families.setdefault((id(kpi.source), kpi.key, kpi.group_key), []).append(kpi)
    for (_, key, group_key), members in families.items():
        measured = _measure(members[0].source, key, members).withColumnRenamed("_group", group_key)
        out = out.join(measured, group_key, "left")
    finished = [
        F.coalesce(F.col(k.name), F.lit(0)).alias(k.name) if k.how in (COUNT, COUNT_DISTINCT) else F.col(k.name)
        for k in kpis
    ]
    return out.select(*groups.columns, *finished, *[F.lit(None).cast("bigint").alias(c) for c in constants])


def _measure(source: DataFrame, key: str, kpis: Sequence[Kpi]) -> DataFrame:
    rows = source.where(F.col(key).isNotNull())
    ids = sorted({k.value for k in kpis if k.how == COUNT_DISTINCT})
    plain = [k for k in kpis if k.how != COUNT_DISTINCT]
    parts = []
    for i in ids:
        own = [k for k in kpis if k.how == COUNT_DISTINCT and k.value == i]
        extra = plain if i == ids[0] else []
        per_id = rows.groupBy(F.col(key).alias("_group"), F.col(i).alias("_id")).agg(
            *[F.max(_true(k)).alias(k.name) for k in own], *_partial(extra)
        )
        counted = [F.count(F.when(F.col(k.name), F.col("_id"))).alias(k.name) for k in own]
        parts.append(per_id.groupBy("_group").agg(*counted, *_final(extra)))
    if not ids:
        parts.append(rows.groupBy(F.col(key).alias("_group")).agg(*_partial(plain)).groupBy("_group").agg(*_final(plain)))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "_group", "full")
    return out


def _true(k: Kpi) -> Column:
    return F.lit(True) if k.where is None else F.coalesce(k.where, F.lit(False))


def _partial(kpis: Sequence[Kpi]) -> list[Column]:
    cols = []
    for k in kpis:
        v = F.col(k.value) if k.where is None else F.when(k.where, F.col(k.value))
        times = F.lit(1) if k.weight is None else F.col(k.weight)
        if k.how in (SUM, INT_AVG):
            cols.append(F.sum(v * times if k.weight else v).alias(f"{k.name}_s"))
        if k.how in (COUNT, INT_AVG):
            cols.append(F.sum(F.when(v.isNotNull(), times).otherwise(0)).alias(f"{k.name}_n"))
    return cols


def _final(kpis: Sequence[Kpi]) -> list[Column]:
    out = []
    for k in kpis:
        s, n = F.sum(f"{k.name}_s"), F.sum(f"{k.name}_n")
        final = {SUM: s, COUNT: n, INT_AVG: whole_quotient(s, n)}[k.how]
        out.append((final.cast("bigint") if k.how != SUM else final).alias(k.name))
    return out
