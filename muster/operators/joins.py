"""Joins by name of intent.

None of them forces a broadcast: Spark broadcasts a side when its measured size is under
spark.sql.autoBroadcastJoinThreshold and otherwise shuffles, splitting hot partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude_matching(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Left rows with no partner. A NULL key has no partner, so it stays."""
    return left.join(right, on, "left_anti")


def keep_matching(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Left rows with a partner; never multiplies rows."""
    return left.join(right, on, "left_semi")


def exclude_not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key is NOT IN the right keys, with SQL's NULL rules.

    A NULL among the right keys leaves nothing; a NULL left key is dropped unless the right side is
    empty. Written as a plain anti join plus two one-row facts about the right side, because Spark's own
    null-aware anti join must broadcast the whole right side.
    """
    facts = right.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    )
    rows = facts.select("rows").scalar()
    nulls = facts.select("nulls").scalar()
    unmatched = left.join(right.select(key), key, "left_anti")
    return unmatched.where((rows == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def join_coalesced(
    left: DataFrame, right: DataFrame, keys: Sequence[Column | str], right_key: str, how: str = "inner"
) -> DataFrame:
    """Joins on the first non-null of several key columns. The key is derived first: a plain equi join."""
    first = F.coalesce(*[F.col(k) if isinstance(k, str) else k for k in keys])
    return left.withColumn(right_key, first).join(right, right_key, how)


def join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str] | str, where: Column) -> DataFrame:
    """Left join to the right rows that satisfy `where`; left rows without such a partner stay."""
    return left.join(right.where(where), on, "left")


def join_on_date(left: DataFrame, right: DataFrame, left_col: str, right_col: str, how: str = "left") -> DataFrame:
    """Joins where both columns fall on the same day, as an equality of days (a hash join)."""
    return (
        left.withColumn("_day", F.to_date(left_col))
        .join(right.withColumn("_day", F.to_date(right_col)), "_day", how)
        .drop("_day")
    )


def coalesce_roles(
    left: DataFrame,
    right: DataFrame,
    on: str,
    roles: Mapping[str, Column],
    columns: Sequence[str],
    extra_on: Mapping[str, str] | None = None,
) -> DataFrame:
    """Joins one table once per role and takes each column from the first role that has it.

    `roles` maps a role name to its filter on the right table. `extra_on` adds, per role, a left column
    that must equal the role's `columns[0]` (or that column be NULL). The single-role columns stay as
    `<role>_<column>`. An entity with two rows in a role yields two rows, as an ordinary left join does.
    """
    out = left
    for role, cond in roles.items():
        part = right.where(cond).select(
            F.col(on).alias(f"_{role}_key"), *[F.col(c).alias(f"{role}_{c}") for c in columns]
        )
        match = F.col(on) == F.col(f"_{role}_key")
        if extra_on and role in extra_on:
            label = F.col(f"{role}_{columns[0]}")
            match = match & ((label == F.col(extra_on[role])) | label.isNull())
        out = out.join(part, match, "left").drop(f"_{role}_key")
    return out.withColumns({c: F.coalesce(*[F.col(f"{r}_{c}") for r in roles]) for c in columns})


def any_link_match(entities: DataFrame, key: str, links: Sequence[DataFrame]) -> DataFrame:
    """Entities named by at least one link set, each once.

    Each alternative of an OR-join is its own equi join, prepared by the caller as a set of keys; the
    union replaces the join on an OR, which would pair every row of one entity with every other.
    """
    found = reduce(DataFrame.unionByName, [link.select(key) for link in links]).distinct()
    return entities.join(found, key, "left_semi")


def flag_presence(df: DataFrame, marked: DataFrame, key: str, col: str, present: str, missing: str) -> DataFrame:
    """Adds `col`: `present` where the key is in `marked`, else `missing`."""
    flags = marked.select(key).distinct().withColumn(col, F.lit(present))
    return df.join(flags, key, "left").withColumn(col, F.coalesce(F.col(col), F.lit(missing)))


def union_sentinel(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Distinct rows plus one constant row for the listed columns."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row).distinct()
