"""Text comparison that ignores letter case, as the label columns need. Codes compare exactly."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_text(col: Column | str, value: str) -> Column:
    return F.lower(_col(col)) == value.lower()


def text_in(col: Column | str, values: Iterable[str]) -> Column:
    """NULL for a NULL text, so neither this nor its negation keeps the row."""
    return F.lower(_col(col)).isin([v.lower() for v in values])


def like(col: Column | str, pattern: str, *, lowered: bool = False) -> Column:
    """LIKE without regard to case; `lowered` tells that the text is in lower case already.

    A pattern of several pieces is matched by a regular expression, which costs many times a plain search. So the text must
    first hold every piece; the expression runs on the few texts that do. NULL stays NULL.
    """
    low, plain = _col(col) if lowered else F.lower(_col(col)), pattern.lower()
    pieces = [p for p in plain.split("%") if p]
    if len(pieces) < 2 or "_" in plain or "\\" in plain:
        return low.like(plain)
    return reduce(and_, [low.contains(p) for p in pieces]) & low.like(plain)


def matches_any(col: Column | str, patterns: Iterable[str], *, lowered: bool = False) -> Column:
    """True when any LIKE pattern fits, ignoring case."""
    return reduce(or_, [like(col, p, lowered=lowered) for p in patterns])


def joined(*parts: Column | str) -> Column:
    """Concatenation that is NULL when any part is NULL. Plain strings are literal text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
