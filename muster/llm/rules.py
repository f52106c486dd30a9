"""Rule bitmask ledger: measurements and one bit per failed rule, taken once; policies and ablations are bit arithmetic on it.

Words are runs of anything but ASCII white space, compared as they stand. A ledger row holds a document's measurements and
`failed`, in which bit k is set when rule k fails. A policy is a version and a mask of the rules it applies: it keeps a row when
failed AND mask is 0. Ablations count, for every policy and rule, the rows that this rule alone removes, from counts of the
ledger's distinct bit patterns, without another look at any text.

Defined cases: null and empty texts and texts without words measure 0 and fail few_words. Repeated rows give repeated ledger rows.
A null doc_id is kept as it is. Any length is measured whole. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm import texts

#: What counts as a symbol, and the rules in the order of their bits. A rule names what fails.
SYMBOLS = "#*$%&|<>"
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "capitals": "100 * n_upper > 60 * n_letters",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]
POLICIES = {"base": BASE, "v1": BASE | BITS["symbols"] | BITS["capitals"], "v2": (1 << len(RULES)) - 1}
CURRENT = "v2"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_HEAD = (np.arange(256) & 0xC0) != 0x80
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_NOT_NEWLINE = texts.table(b"\n")


def _equal_to_another(who: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per value: its text has the value more than once; it is not the first of them. Values come in text order."""
    order = np.argsort(h ^ texts.mix(who.astype(np.uint64)), kind="stable")
    w, v = who[order], h[order]
    same = (w[1:] == w[:-1]) & (v[1:] == v[:-1])
    later = np.concatenate([[False], same])
    any_of = later | np.concatenate([same, [False]])
    more, again = np.empty(len(h), bool), np.empty(len(h), bool)
    more[order], again[order] = any_of, later
    return more, again


def measure(t: texts.Texts) -> dict[str, np.ndarray]:
    """The measurements of every text of a slice."""
    d, n = t.data, len(t)
    w = texts.words(t, texts.SPACED)
    sums = texts.prefix(d)
    per = lambda flags: texts.totals(flags[d], t.off)
    n_words = np.diff(w.by)

    spaced = texts.totals(_HEAD[d] & texts.SPACED[d], t.off)
    h = texts.ranges(sums, w.start, w.end)
    at = texts.inside(w.by, 3)
    more, _ = _equal_to_another(w.text[at], texts.runs(h, 3)[at])
    hit = np.zeros(len(h) + 2, bool)
    for k in range(3):
        hit[at[more] + k] = True
    repeats = texts.totals(hit[: len(h)], w.by)

    line = texts.words(t, _NOT_NEWLINE)
    worded = np.searchsorted(w.start, line.end) > np.searchsorted(w.start, line.start)
    who = line.text[worded]
    _, again = _equal_to_another(who, texts.ranges(sums, line.start[worded], line.end[worded]))
    return {
        "n_words": n_words, "word_chars": spaced, "n_symbols": per(_SYMBOL), "n_dup_lines": np.bincount(who[again], minlength=n),
        "n_repeat_words": repeats, "n_lines": np.bincount(who, minlength=n), "n_upper": per(_UPPER), "n_letters": per(_LETTER),
    }


def failed_bits() -> Column:
    """The bitmask over measurement columns."""
    out = F.lit(0).cast("long")
    for name, fails in RULES.items():
        out = out.bitwiseOR(F.when(F.expr(fails), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failed) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts.slices(b.column(1)):
                m = measure(t)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), *(pa.array(m[c].astype(np.int64)) for c in MEASURES)], names=["doc_id", *MEASURES])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in MEASURES)).withColumn("failed", failed_bits())


def passes(mask: int) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask)) == 0


def ablations(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """(version, rule, n_rows, n_kept, n_only): rows kept by the policy, and rows that the rule alone removes from it."""
    cases = [F.struct(F.lit(v).alias("version"), F.lit(m).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for v, m in policies.items() for r, b in BITS.items() if m & b]
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    hit = patterns.select("failed", "n", F.explode(F.array(*cases)).alias("c")).select("n", "c.*", F.col("failed").bitwiseAND(F.col("c.mask")).alias("left"))
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")
    return hit.groupBy("version", "rule").agg(F.sum("n").alias("n_rows"), count(F.col("left") == 0).alias("n_kept"), count(F.col("left") == F.col("bit")).alias("n_only"))
