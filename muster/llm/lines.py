"""Line removal by overlapping three-line windows, in DataFrame functions alone.

Prose often keeps a paragraph on one line, so a text is cut into lines by its content: at newlines, behind words that end in a
sentence or clause mark, behind ideographic stops, and behind every twelfth word since the last cut. Cuts depend on the words
since the last mark or newline alone, so copies of a passage are cut alike from their first mark on. A line carries all white space
behind it; lines put together are the text, to the last character.

Three consecutive lines are a window, named by two hashes of its lines without their outer white space. Windows found more than once in
all documents are repeated; the first occurrence, by doc_id, text hash and place, stays, and the lines under every later one
are removed, overlapping windows being merged. So a repeated passage of three or more lines goes wherever it occurs again, within a
text or across, however short its lines are. What stays of a repeated passage are the words before its first mark and the rest of its last
line, and a passage of fewer than three lines.

Defined cases: a null text stays null, an empty one empty, both without lines; a text of fewer than three lines is left as it is. White
space before the first word is a line of its own. Rows that repeat both doc_id and text are one document and are cleaned alike. A
null doc_id comes before all others. Any character may occur; none is reserved. Extra columns pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import staged, text_key

WORDS = 12
#: What a word ends in for a cut to follow, and what is cut behind without white space.
MARKS, STOPS = ".!?;:,…", "。！？；，、"
_SPACE, _BLANK = r"\x20\x09-\x0D", r"\x20\x09\x0B-\x0D"
#: Words without a mark and with white space, but no newline, behind them; a last word of any kind; all white space behind it.
LINE = (
    rf"(?:[^{_SPACE}{STOPS}]*[^{_SPACE}{STOPS}{MARKS}][{_BLANK}]+){{0,{WORDS - 1}}}(?:[^{_SPACE}{STOPS}]+[{STOPS}]*|[{STOPS}]+)[{_SPACE}]*|[{_SPACE}]+"
)
#: The same for texts without a stop, in which a word is a run without white space: one pass, nothing tried twice.
PLAIN = rf"(?:\S++(?<![{MARKS}])[{_BLANK}]++(?=\S)){{0,{WORDS - 1}}}+\S++\s*+|\s++"
_WHITE = " \t\n\x0b\x0c\r"
_DOC, _KEY = "_doc", "_key"


def lines(text: Column) -> Column:
    """The lines of a text, which put together are the text."""
    stopped = reduce(or_, [F.contains(text, F.lit(c)) for c in STOPS])
    return F.when(stopped, F.regexp_extract_all(text, F.lit(LINE), F.lit(0))).otherwise(F.regexp_extract_all(text, F.lit(PLAIN), F.lit(0)))


def _hashed(docs: DataFrame) -> DataFrame:
    """(_doc, _key, h): per document the hashes of its lines without their outer white space."""
    bare = F.transform(lines(F.col("text").cast("string")), lambda x: F.xxhash64(F.btrim(x, F.lit(_WHITE))))
    return docs.select(F.col("doc_id").cast("long").alias(_DOC), text_key(F.col("text")).alias(_KEY), bare.alias("h"))


def _windows(hashed: DataFrame) -> DataFrame:
    """(_doc, _key, place, w, v): each window, with two hashes that name it."""
    rows = hashed.where(F.size("h") >= 3).select(_DOC, _KEY, "h", F.explode(F.sequence(F.lit(0), F.size("h") - 3)).alias("place"))
    three = [F.col("h")[F.col("place") + k] for k in range(3)]
    return rows.select(_DOC, _KEY, "place", F.xxhash64(*three).alias("w"), F.hash(*three[::-1]).alias("v"))


def later_windows(docs: DataFrame) -> DataFrame:
    """(_doc, _key, place) of every window that stands earlier too."""
    windows = _windows(staged(_hashed(docs), "line-hashes"))
    repeated = staged(windows.groupBy("w", "v").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("w", "v"), "repeated")
    found = staged(windows.join(repeated, ["w", "v"]), "occurrences")
    spot = F.struct(_DOC, _KEY, "place")
    first = staged(found.groupBy("w", "v").agg(F.min(spot).alias("first")), "first")
    return found.join(first, ["w", "v"]).where(F.col("first") != spot).select(_DOC, _KEY, "place")


def cleaned(docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_removed): each row of `docs` as a struct, its text without the repeated lines, and two counts."""
    per = later_windows(docs).groupBy(F.col(_DOC).alias("_d"), F.col(_KEY).alias("_k")).agg(F.collect_set("place").alias("_places"))
    covered = F.array_distinct(F.flatten(F.transform("_places", lambda p: F.array(p, p + 1, p + 2))))
    per = per.select("_d", "_k", covered.alias("_gone"))
    text = F.col("text").cast("string")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text.alias("text"), F.col("doc_id").cast("long").alias(_DOC), text_key(F.col("text")).alias(_KEY))
    both = keyed.join(per, (F.col(_KEY) == F.col("_k")) & F.col(_DOC).eqNullSafe(F.col("_d")), "left")
    both = both.withColumn("_lines", lines(F.col("text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "")
    return both.select(
        "row", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with the repeated lines gone from text, and n_lines and n_removed (in place of columns of these names)."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return cleaned(docs).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in kept], "n_lines", "n_removed")
