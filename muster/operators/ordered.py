"""Ordered computations per key that do not depend on one task holding a whole key.

A window partitioned by key puts every row of that key in one task. Here every key is cut into slices of its order column;
the window runs per (key, slice), and a summary with one row per slice carries the missing state from slice to slice.
All keys take this one path, whatever their size. Times are cut by the clock (a day, or `width` minutes) and dates by 32
days (or `width`). Any other order column is cut at boundaries taken from the data: one value of each of SLICES hash
groups of its distinct values, so there are at most SLICES + 1 slices and no slice depends on how numbers or texts are spread.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 63
_KEY, _SLICE = "_key", "_slice"
_NULL_SLICE = -(2**62)
_EPOCH = dt.date(1970, 1, 1)


def bucket(df: DataFrame, col: str, width: int | None = None) -> Column:
    """Slice number of an order value; it never falls when the value rises. NULL has a slice below all others."""
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, T.DateType):
        n = F.floor(F.datediff(c, F.lit(_EPOCH)) / (width or 32))
    elif isinstance(kind, T.TimestampType):
        # Instants, not wall clock: hours that come twice when clocks go back stay in order.
        n = F.call_function("div", F.unix_micros(c) - F.pmod(F.unix_micros(c), F.lit((width or 1440) * 60_000_000)), F.lit((width or 1440) * 60_000_000))
    elif isinstance(kind, T.TimestampNTZType):
        minutes = F.datediff(F.to_date(c), F.lit(_EPOCH)).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
        n = F.floor(minutes / (width or 1440))
    else:
        n = _between(c, _boundaries(df, col))
    return F.coalesce(n.cast("bigint"), F.lit(_NULL_SLICE))


def _boundaries(df: DataFrame, col: str) -> list:
    """At most SLICES values of the column in ascending order: of each hash group of its values, the one of highest hash."""
    c = F.col(col)
    kept = df.where(c.isNotNull()).groupBy(F.pmod(F.xxhash64(c), F.lit(SLICES)).alias("g")).agg(F.max_by(c, F.xxhash64(c, F.lit(1))).alias("v"))
    return [r[0] for r in kept.select("v").distinct().orderBy("v").collect()]


def _between(c: Column, bounds: list, low: int = 0) -> Column:
    """How many boundaries are at or below the value, by halving; NULL for NULL."""
    if not bounds:
        return F.when(c.isNotNull(), F.lit(low))
    mid = len(bounds) // 2
    return F.when(c < F.lit(bounds[mid]), _between(c, bounds[:mid], low)).when(c.isNotNull(), _between(c, bounds[mid + 1 :], low + mid + 1))


def _sliced(df: DataFrame, keys: Sequence[str], first: str, width: int | None) -> DataFrame:
    # A struct key compares NULL fields as equal, like PARTITION BY, and still joins by hash.
    return df.withColumns({_KEY: F.struct(*keys), _SLICE: bucket(df, first, width)})


def _direction(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def _with_carry(local: DataFrame, summary: DataFrame) -> DataFrame:
    return local.join(summary, [_KEY, _SLICE], "left")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Mapping[str, str],
    *,
    forward: bool = False,
    descending: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Adds columns of the row just before (or, with `forward`, just after) in the key's order.

    `take` maps a new column name to the neighbour's column. `order` must identify a row within its key.
    The new columns are NULL where there is no neighbour.
    """
    rows = _sliced(df, keys, order[0], width)
    back = descending != forward  # walking the order backwards turns the next row into the previous one
    w = Window.partitionBy(_KEY, _SLICE).orderBy(*_direction(order, back))
    payload = F.struct(*[F.col(c).alias(n) for n, c in take.items()])
    local = rows.withColumn("_near", F.lag(payload).over(w))

    position = F.struct(*order)
    edge = F.min_by(payload, position) if back else F.max_by(payload, position)
    across = Window.partitionBy(_KEY).orderBy(*_direction([_SLICE], back))
    summary = (
        rows.groupBy(_KEY, _SLICE)
        .agg(edge.alias("_edge"))
        .select(_KEY, _SLICE, F.lag("_edge").over(across).alias("_carry"))
    )
    found = F.coalesce(F.col("_near"), F.col("_carry"))
    return _with_carry(local, summary).withColumn("_found", found).select(
        *df.columns, *[F.col("_found")[n].alias(n) for n in take]
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, *, width: int | None = None
) -> DataFrame:
    """Replaces `col` by its last non-null value up to and including each row."""
    rows = _sliced(df, keys, order[0], width)
    w = Window.partitionBy(_KEY, _SLICE).orderBy(*_direction(order, False))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_near", F.last(col, ignorenulls=True).over(upto))

    known = F.when(F.col(col).isNotNull(), F.struct(*order))
    across = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        rows.groupBy(_KEY, _SLICE)
        .agg(F.max_by(col, known).alias("_edge"))
        .select(_KEY, _SLICE, F.last("_edge", ignorenulls=True).over(across).alias("_carry"))
    )
    rest = [c for c in df.columns if c != col]
    return _with_carry(local, summary).select(*rest, F.coalesce("_near", "_carry").alias(col))


def running_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    *,
    descending: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Adds the row's 1-based position in its key. `order` must identify a row within its key."""
    rows = _sliced(df, keys, order[0], width)
    w = Window.partitionBy(_KEY, _SLICE).orderBy(*_direction(order, descending))
    local = rows.withColumn("_near", F.row_number().over(w))

    across = (
        Window.partitionBy(_KEY)
        .orderBy(*_direction([_SLICE], descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summary = (
        rows.groupBy(_KEY, _SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_KEY, _SLICE, F.sum("_n").over(across).alias("_carry"))
    )
    number = F.col("_near") + F.coalesce(F.col("_carry"), F.lit(0))
    return _with_carry(local, summary).select(*df.columns, number.cast("bigint").alias(name))
