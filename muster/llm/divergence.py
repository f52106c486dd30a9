"""Source divergence audit by count-level bitmaps.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms found in at least `least_docs` of its
documents. Kept terms are numbered by falling frequency and laid in blocks of 64, so that a block's terms have like counts.
For every group (a source within a language), count and block one 64-bit map says which terms have that count. For two groups,
AND and popcount of their maps give the block's joint cells: how many terms have count c in one and d in the other. Cells are
multiplied by f(p, q) = (p - q) * (p - q) div q of the smoothed shares p and q of the two counts. Terms that a group does not have are
in no map: with J the joint cells, the cells (c, 0), (0, d) and (0, 0) are the complements n(c) - J(c, .), n(d) - J(., d) and
V - n - n + J, so their part is a sum over levels, not terms.

Shares are p = 1 + 10^9 * (count + 1) div (N + V), N the group's occurrences of kept terms and V their number. Numerators are decimals, and
sums of J * f stay below (10^9 + V)^2, which a long holds for V up to 10^9; they meet in a decimal.

Defined cases: null text, lang and source are ''. A group without terms, or of a language without kept terms, has all its pairs; with V = 0
their value is 0. Repeated rows count as documents of their own; doc_id and extra columns are not read. An empty table gives no rows. Long
texts are taken whole. Terms are told apart by their bytes, never by a hash of them. Counts are summed within a task before they are
shuffled by term, so a hot source spreads over its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm import texts
from muster.llm.common import staged

LEAST_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Rows (group, term) a task gathers before it hands them on.
HELD = 1 << 18
_LETTERS = texts.table(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _coded(terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each term among the distinct ones, and those: equal numbers are equal terms, no hash decides."""
    coded = terms.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


class _Counts:
    """Occurrences and documents by (group, term), gathered over slices in a bounded table."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.size = self.folded = 0

    def add(self, t: texts.Texts, groups: np.ndarray) -> None:
        t.data = texts.LOWER[t.data]
        w = texts.words(t, _LETTERS)
        if not len(w.start):
            return
        size = w.end - w.start
        off = np.concatenate([[0], np.cumsum(size)])
        data = t.data[np.repeat(w.start - off[:-1], size) + np.arange(off[-1])]
        code, terms = _coded(pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())))
        said, n = np.unique(w.text * len(terms) + code, return_counts=True)
        text, code = said // len(terms), said % len(terms)
        key, which, docs = np.unique(groups[text] * len(terms) + code, return_inverse=True, return_counts=True)
        self.parts.append((key // len(terms), np.bincount(which, n).astype(np.int64), docs, terms.take(pa.array(key % len(terms)))))
        self.size += len(key)
        if self.size > max(HELD, 2 * self.folded):
            self.fold()

    def fold(self) -> None:
        group, n, docs, terms = (list(x) for x in zip(*self.parts))
        code, terms = _coded(pa.concat_arrays(terms))
        key, which = np.unique(np.concatenate(group) * len(terms) + code, return_inverse=True)
        total = lambda x: np.bincount(which, np.concatenate(x)).astype(np.int64)
        self.parts = [(key // len(terms), total(n), total(docs), terms.take(pa.array(key % len(terms))))]
        self.size = self.folded = len(key)

    def taken(self) -> pa.RecordBatch | None:
        """All that is held, as a batch; the table is empty afterwards."""
        if not self.parts:
            return None
        self.fold()
        group, n, docs, terms = self.parts[0]
        names = list(self.groups)
        column = lambda k: pa.array([x[k] for x in names], pa.string()).take(pa.array(group))
        out = pa.RecordBatch.from_arrays([column(0), column(1), terms.cast(pa.string()), pa.array(n), pa.array(docs.astype(np.int64))], names=["lang", "source", "term", "n", "docs"])
        self.parts, self.groups, self.size, self.folded = [], {}, 0, 0
        return out


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for b in batches:
            group = np.array([held.groups.setdefault(g, len(held.groups)) for g in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], np.int64)
            for t in texts.slices(b.column(2)):
                held.add(t, group[t.first : t.first + len(t)])
            if held.size > HELD // 2:
                yield held.taken()
        if (rest := held.taken()) is not None:
            yield rest

    found = _named(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + terms)); null where there are no terms."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count if isinstance(count, Column) else F.col(count) + 1).cast("decimal(20,0)")
    return 1 + F.call_function("div", above, F.nullif(F.col(total) + F.col(terms), F.lit(0)).cast("decimal(20,0)"))


def gap(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _kept(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, total, block, bit) of the kept terms, numbered within slices by falling frequency."""
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    order = ["lang", F.desc("total"), "term"]
    numbered = terms.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    return numbered.select("lang", "term", "total", F.shiftright("id", 6).alias("block"), F.col("id").bitwiseAND(F.lit(63)).cast("int").alias("bit"))


def _levels(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, block, source, p, p0, bits): which terms of the block have a share in the group; p0 is the share of no occurrence."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    rows = counted.groupBy("lang", "source", "block", "n").agg(F.bit_or(bit).alias("bits"))
    return rows.join(groups, ["lang", "source"]).select("lang", "block", "source", share("n", "occurrences", "terms").alias("p"), "p0", "bits")


def _joint(levels: DataFrame) -> DataFrame:
    """(lang, a, b, joint, and the sums of J * f both ways: of both shares, and of either one with the other's share of none), a < b."""
    one, two = (levels.select("lang", "block", F.col("source").alias(s), F.col("p").alias(f"p{s}"), F.col("p0").alias(f"o{s}"), F.col("bits").alias(f"bits{s}")) for s in "ab")
    both = F.col("bitsa").bitwiseAND(F.col("bitsb"))
    cells = one.join(two, ["lang", "block"]).where((F.col("a") < F.col("b")) & (both != 0)).withColumn("j", F.bit_count(both).cast("long"))
    total = lambda p, q: F.sum(F.col("j") * gap(p, q))
    return cells.groupBy("lang", "a", "b").agg(
        F.sum("j").alias("joint"),
        total("pa", "pb").alias("ab"), total("pa", "ob").alias("ab_c0"), total("oa", "pb").alias("ab_0d"),
        total("pb", "pa").alias("ba"), total("pb", "oa").alias("ba_c0"), total("ob", "pa").alias("ba_0d"),
    )


def _alone(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, as_p, as_q): sums over the source's levels of n * f against the other's share of none, either way round."""
    counts = levels.groupBy("lang", "source", "p").agg(F.sum(F.bit_count("bits")).cast("long").alias("n"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q"))
    rows = counts.join(others, "lang").where("source <> other")
    return rows.groupBy("lang", "source", "other").agg(F.sum(F.col("n") * gap("p", "q")).alias("as_p"), F.sum(F.col("n") * gap("q", "p")).alias("as_q"))


def pairs(groups: DataFrame, levels: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    joint, alone = staged(_joint(levels), "joint"), staged(_alone(levels, groups), "alone")
    way = lambda s, o, x: joint.select("lang", F.col(s).alias("source"), F.col(o).alias("item"), "joint", F.col(x).alias("both"), F.col(f"{x}_c0").alias("c0"), F.col(f"{x}_0d").alias("d0"))
    cells = way("a", "b", "ab").union(way("b", "a", "ba"))
    one = groups.select("lang", "source", "terms", F.col("n_terms").alias("n1"), F.col("p0").alias("p"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("n_terms").alias("n2"), F.col("p0").alias("q"))
    rows = one.join(two, "lang").where("source <> item").join(cells, ["lang", "source", "item"], "left")
    rows = rows.join(alone.select("lang", "source", F.col("other").alias("item"), "as_p"), ["lang", "source", "item"], "left")
    rows = rows.join(alone.select("lang", F.col("source").alias("item"), F.col("other").alias("source"), "as_q"), ["lang", "source", "item"], "left")
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)")
    none = gap("p", "q").cast("decimal(38,0)") * (F.col("terms") - F.col("n1") - F.col("n2") + F.coalesce("joint", F.lit(0))).cast("decimal(20,0)")
    value = whole("both") + (whole("as_p") - whole("c0")) + (whole("as_q") - whole("d0")) + none
    return rows.select("lang", "source", "item", F.when(F.col("terms") > 0, value).otherwise(0).cast("long").alias("value"))


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's term shares lie from each other source's of its language (part
    pair, all of them) and which terms it says more often than the language as a whole (part term, the `top` ones)."""
    counts = staged(term_counts(docs), "term-counts")
    kept = staged(_kept(counts, least_docs), "kept-terms")
    counted = staged(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total", "block", "bit"), "counted")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_occurrences"))
    sums = counted.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_terms"))
    groups = _named(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("occurrences", "n_terms", "terms", "lang_occurrences")}
    groups = staged(groups.withColumns(zero).withColumn("p0", share(F.lit(1), "occurrences", "terms")), "groups")
    between = pairs(groups, staged(_levels(counted, groups), "levels"))

    shares = counted.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), share("n", "occurrences", "terms").alias("p"), share("total", "lang_occurrences", "terms").alias("q"))
    above = shares.where("p > q").select("lang", "source", "item", gap("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(between, "pair").union(ranked(above, "term").where(F.col("rank") <= top))
