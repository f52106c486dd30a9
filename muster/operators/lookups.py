"""Lookups by time: which row was valid at, or last before, a moment; what came next.

All of them work on distinct (key, moment) pairs and join the answer back, so no key ever pairs all its
left rows with all its right rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import dates
from muster.operators import ordered

# Day numbers are counted from 0001-01-01, so six base-16 levels span every Spark date, in days and in slots of 64 days.
_EPOCH = dt.date(1970, 1, 1)
_EPOCH_NUMBER = _EPOCH.toordinal() - 1
_BASE_BITS = 4
_BASE = 2**_BASE_BITS
_LEVELS = 6
_SLOT_BITS = 6


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    at: str,
    ts: str,
    take: Mapping[str, str],
    *,
    tie: str,
    by_day: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Adds, per left row, columns of the right row latest at or before `at`; NULL where there is none.

    `take` maps new names to right columns. Right rows of one key and time are settled by the highest
    `tie`. With `by_day` both times are compared as days.
    """
    as_moment = F.to_date if by_day else F.col
    asked = left.select(key, as_moment(at).alias("_at")).dropna().distinct()
    offered = (
        right.select(F.col(key), as_moment(ts).alias("_at"), F.struct(F.col(tie).alias("_tie"), *_aliased(take)).alias("_hit"))
        .where(F.col(key).isNotNull() & F.col("_at").isNotNull())
        .groupBy(key, "_at")
        .agg(F.max("_hit").alias("_hit"))
    )
    hit_type = offered.schema["_hit"].dataType
    line = offered.withColumn("_side", F.lit(0)).unionByName(
        asked.withColumns({"_hit": F.lit(None).cast(hit_type), "_side": F.lit(1)})
    )
    answered = ordered.carry_forward(
        line, [key], ["_at", "_side"], "_hit", width=width
    ).where("_side = 1")
    return _attach(left.withColumn("_at", as_moment(at)), answered, [key, "_at"], take).drop("_at")


def latest_lookup(left: DataFrame, right: DataFrame, key: str, order: Column, take: Mapping[str, str]) -> DataFrame:
    """Adds columns of the right row with the highest `order` per key, without a time bound."""
    best = right.groupBy(key).agg(F.max(F.struct(order.alias("_order"), *_aliased(take))).alias("_hit"))
    return _attach(left, best, [key], take)


def range_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    at: str,
    start: Column,
    end: Column,
    order: Column,
    take: Mapping[str, str],
    *,
    tie: str,
) -> DataFrame:
    """Adds columns of the right row whose [start, end] contains the day of `at`; the highest `order` wins,
    then the highest `tie`. Overlapping ranges are allowed. NULL where no range contains the day.

    A range has a piece in the first and one in the last slot of 64 days it touches; what lies between is cut into blocks of 1, 16,
    256, ... slots. Equal pieces and equal blocks keep only their winner. A day is compared with the pieces of its slot, at most
    2,080 whatever the number of ranges, and answered by one equality probe per block size that the ranges need.
    """
    spans = right.select(
        F.col(key),
        _day_number(start, up=True).alias("_from"),
        _day_number(end).alias("_to"),
        F.struct(order.alias("_order"), F.col(tie).alias("_tie"), *_aliased(take)).alias("_hit"),
    ).where(F.col(key).isNotNull() & (F.col("_from") <= F.col("_to")))
    asked = left.select(key, F.to_date(at).alias("_at")).dropna().distinct().withColumn("_day", _day_number(F.col("_at")))

    pieces = _with_pieces(spans).groupBy(key, "_slot", "_from", "_to").agg(F.max("_hit").alias("_hit"))
    found = (
        asked.withColumn("_slot", F.shiftright("_day", _SLOT_BITS))
        .join(pieces, [key, "_slot"])
        .where(F.col("_day").between(F.col("_from"), F.col("_to")))
        .select(key, "_at", "_hit")
    )
    inner = spans.withColumns({
        "_from": F.shiftright("_from", _SLOT_BITS) + 1, "_to": F.shiftright("_to", _SLOT_BITS) - 1,
    }).where("_from <= _to")
    levels = _levels_needed(inner.agg(F.max(F.col("_to") - F.col("_from") + 1)).first()[0])
    if levels:
        blocks = _with_blocks(inner, levels).groupBy(key, "_level", "_slot").agg(F.max("_hit").alias("_hit"))
        probes = asked.withColumn("_level", F.explode(_levels(levels))).withColumn(
            "_slot", _slot(F.shiftright("_day", _SLOT_BITS)))
        found = found.unionByName(probes.join(blocks, [key, "_level", "_slot"]).select(key, "_at", "_hit"))
    answered = found.groupBy(key, "_at").agg(F.max("_hit").alias("_hit"))
    return _attach(left.withColumn("_at", F.to_date(at)), answered, [key, "_at"], take).drop("_at")


def contiguous_predecessor(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    same: str,
    start: str,
    end: Column,
    max_gap: int,
    take: Mapping[str, str],
    *,
    width: int | None = None,
) -> DataFrame:
    """Adds columns of the key's previous row when it has the same `same` value, began no later, and ended
    at most `max_gap` days before this row's start; otherwise NULL. `order` ends in a unique column."""
    inner = {"_p_same": same, "_p_start": start, "_p_end": "_end", **{f"_p_{n}": c for n, c in take.items()}}
    near = ordered.neighbour(
        df.withColumn("_end", end), [key], order, inner, width=width
    )
    linked = (
        (F.col("_p_same") == F.col(same))
        & (F.to_date("_p_start") <= F.to_date(start))
        & (dates.day_gap(F.col("_p_end"), F.col(start)) <= max_gap)
    )
    return near.select(*df.columns, *[F.when(linked, F.col(f"_p_{n}")).alias(n) for n in take])


def next_event(
    df: DataFrame,
    key: str,
    order: str,
    take: Mapping[str, str],
    *,
    of: DataFrame | None = None,
    width: int | None = None,
) -> DataFrame:
    """Pairs each row of `of` (default: df) with every row of df at the key's next later distinct time.

    Rows at one time share their successor, and several successors at one time give several rows; rows at
    the newest time give none.
    """
    left = df if of is None else of
    times = ordered.neighbour(
        df.select(key, order).distinct(), [key], [order], {"_next": order},
        forward=True, width=width,
    ).where(F.col("_next").isNotNull())
    after = df.select(F.col(key), F.col(order).alias("_next"), *_aliased(take))
    return left.join(times, [key, order]).join(after, [key, "_next"]).drop("_next")


def next_status_after(
    events: DataFrame, anchors: DataFrame, keys: Sequence[str], ts: str, status: str, anchor_ts: str, name: str
) -> DataFrame:
    """Distinct (keys, status) of each anchored entity's first event on a later day than an anchor.

    With several anchors the first one decides, because an event after any anchor is after the first.
    Statuses that share that first time are all kept.
    """
    since = anchors.groupBy(*keys).agg(F.min(F.to_date(anchor_ts)).alias("_since"))
    later = events.join(since, list(keys)).where(F.to_date(ts) > F.col("_since"))
    first = later.groupBy(*keys).agg(F.min(ts).alias(ts))
    return later.join(first, [*keys, ts]).select(*keys, F.col(status).alias(name)).distinct()


def _aliased(take: Mapping[str, str]) -> list[Column]:
    return [F.col(c).alias(n) for n, c in take.items()]


def _attach(left: DataFrame, answers: DataFrame, on: Sequence[str], take: Mapping[str, str]) -> DataFrame:
    found = answers.select(*on, "_hit")
    return left.join(found, list(on), "left").select(
        *left.columns, *[F.col("_hit")[n].alias(n) for n in take]
    )


def _day_number(col: Column, up: bool = False) -> Column:
    """Day count of a moment; with `up`, of the first midnight not before it."""
    n = F.datediff(F.to_date(col), F.lit(_EPOCH)) + _EPOCH_NUMBER
    if up:
        n = n + F.when(col > F.to_date(col), 1).otherwise(0)
    return n


def _levels(count: int) -> Column:
    return F.array(*[F.lit(n) for n in range(count)])


def _levels_needed(widest: int | None) -> int:
    """How many block sizes fit into the widest range; none without one."""
    return sum(_BASE**n <= (widest or 0) for n in range(_LEVELS))


def _with_pieces(spans: DataFrame) -> DataFrame:
    """One row per part of a span in the first and in the last slot it touches, cut to that slot."""
    first, last = F.shiftright("_from", _SLOT_BITS), F.shiftright("_to", _SLOT_BITS)
    slots = F.when(first == last, F.array(first)).otherwise(F.array(first, last))
    start = F.call_function("shiftleft", F.col("_slot"), F.lit(_SLOT_BITS))
    cut = spans.withColumn("_slot", F.explode(slots))
    return cut.withColumns({"_from": F.greatest("_from", start), "_to": F.least(F.col("_to"), start + (2**_SLOT_BITS - 1))})


def _slot(number: Column, level: Column | None = None) -> Column:
    """Index of the block of the level's size (16 ** level days) that a day number lies in."""
    level = F.col("_level") if level is None else level
    return F.call_function("shiftright", number, level * _BASE_BITS)


def _span(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _with_blocks(spans: DataFrame, levels: int) -> DataFrame:
    """One row per block, the blocks tiling the numbers _from.._to exactly, largest possible first."""

    def whole(level: Column) -> tuple[Column, Column]:
        """First and last block of a size that lie wholly inside the span."""
        up = F.call_function("shiftleft", F.lit(1), level * _BASE_BITS) - 1
        return _slot(F.col("_from") + up, level), _slot(F.col("_to") + 1, level) - 1

    level = F.col("_level")
    first, last = whole(level)
    outer_first, outer_last = whole(level + 1)
    sized = spans.withColumn("_level", F.explode(_levels(levels))).withColumns(
        {"_first": first, "_last": last, "_outer_first": outer_first, "_outer_last": outer_last}
    )
    # Days covered by larger blocks are left out: only the margins on either side remain at this size.
    covered = (level < _LEVELS - 1) & (F.col("_outer_first") <= F.col("_outer_last"))
    margins = F.concat(
        _span(F.col("_first"), F.col("_outer_first") * _BASE - 1),
        _span((F.col("_outer_last") + 1) * _BASE, F.col("_last")),
    )
    slots = F.when(covered, margins).otherwise(_span(F.col("_first"), F.col("_last")))
    return sized.withColumn("_slot", F.explode(slots)).select(*spans.columns, "_level", "_slot")
