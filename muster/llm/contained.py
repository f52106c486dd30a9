"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item is cut into item-sized windows of at most `window` consecutive words; a window is the set of its word shingles. A
document window that holds at least `share` of them must hold one of the window's first m - ceil(share * m) + 1
shingles, whatever order they stand in. So shingles are ordered by rarity, counted over all documents, and only those
prefixes are joined. The shingle's place in the window bounds where a match can begin and end in the document; what is
left is verified on the words themselves: the same words in the same order for share 1, else the count of shared shingles.

A bitmap of fixed size lets a document's words by unless they may be prefix shingles; the join decides.

Defined cases: null texts and texts without words hold nothing and give no windows. An item of fewer words than a window is one
window. Items with equal windows are all reported. Windows of repeated rows are found for each row's (doc_id, text hash),
once. Items with a null item_id are found under null. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm import bitmaps, texts
from muster.llm.common import staged, text_key

WINDOW, SHINGLE = 10, 4


def _hashed(t: texts.Texts) -> tuple[texts.Words, np.ndarray]:
    t.data = texts.LOWER[t.data]
    w = texts.words(t, texts.ALNUM)
    return w, texts.ranges(texts.prefix(t.data), w.start, w.end)


def _strings(t: texts.Texts, w: texts.Words, a: int, b: int) -> list[str]:
    return [t.data[s:e].tobytes().decode() for s, e in zip(w.start[a:b], w.end[a:b])]


_WINDOWS = "item_id string, words array<string>, shingles array<struct<g:bigint,place:int,width:int>>"


def windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, words, shingles): every window of every item, with its distinct shingles and their first places."""
    kind = pa.list_(pa.struct([("g", pa.int64()), ("place", pa.int32()), ("width", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts.slices(b.column(1)):
                w, h = _hashed(t)
                ids, found, grams = [], [], []
                for i in range(len(t)):
                    a, z = int(w.by[i]), int(w.by[i + 1])
                    said = _strings(t, w, a, z)
                    for k in range(a, max(a + 1, z - window + 1)) if z > a else ():
                        end = min(z, k + window)
                        width = min(shingle, end - k)
                        first: dict[int, int] = {}
                        for place, g in enumerate(texts.int64(texts.runs(h[k:end], width)).tolist()):
                            first.setdefault(g, place)
                        ids.append(b.column(0)[t.first + i].as_py())
                        found.append(said[k - a : end - a])
                        grams.append([{"g": g, "place": p, "width": width} for g, p in first.items()])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.string())), pa.array(grams, kind)], names=["item_id", "words", "shingles"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _WINDOWS)


def _widths(entries: DataFrame) -> list[int]:
    return sorted(r[0] for r in entries.select("width").distinct().collect())  # at most `shingle` of them


def _frequencies(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """(g, times): how often each item shingle occurs in all documents."""
    held = docs.sparkSession.sparkContext.broadcast(bitmaps.build(entries.select("g").distinct(), "g"))
    widths = _widths(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts.slices(b.column(0)):
                w, h = _hashed(t)
                for k in widths:
                    g = texts.runs(h, k)[texts.inside(w.by, k)]
                    g, n = np.unique(g[bitmaps.has(held.value, g)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(texts.int64(g)), pa.array(n, pa.int64())], names=["g", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "g long, n long")
    return counted.groupBy("g").agg(F.sum("n").alias("times"))


_PROBED = "doc_id bigint, key bigint, n_words bigint, probes array<struct<g:bigint,pos:bigint,`from`:bigint,around:array<string>>>"


def _probed(docs: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """A row per document with its word count and the places where a prefix shingle may stand, each with the words around
    it that a window through it can reach."""
    held = docs.sparkSession.sparkContext.broadcast(bitmaps.build(prefixes.select("g").distinct(), "g"))
    widths = _widths(prefixes)
    kind = pa.list_(pa.struct([("g", pa.int64()), ("pos", pa.int64()), ("from", pa.int64()), ("around", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts.slices(b.column(2)):
                w, h = _hashed(t)
                probes: list[list[dict]] = [[] for _ in range(len(t))]
                for k in widths:
                    at = texts.inside(w.by, k)
                    g = texts.runs(h, k)[at]
                    hit = np.flatnonzero(bitmaps.has(held.value, g))
                    who = np.searchsorted(w.by, at[hit], "right") - 1
                    for i, p, v in zip(who.tolist(), at[hit].tolist(), texts.int64(g[hit]).tolist()):
                        lo, hi = max(int(w.by[i]), p - window + k), min(int(w.by[i + 1]), p + window)
                        probes[i].append({"g": v, "pos": p - int(w.by[i]), "from": lo - int(w.by[i]), "around": _strings(t, w, lo, hi)})
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(t.first, len(t)), b.column(1).slice(t.first, len(t)), pa.array(np.diff(w.by), pa.int64()), pa.array(probes, kind)],
                    names=["doc_id", "key", "n_words", "probes"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _PROBED)


def _shared(words: Column, other: Column, width: Column) -> Column:
    """How many distinct shingles of `words` are also in `other`."""

    def grams(a: Column) -> Column:
        places = F.when(F.size(a) >= width, F.sequence(F.lit(0), F.size(a) - width)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.array_join(F.slice(a, i + 1, width), " "))

    return F.size(F.array_intersect(grams(words), grams(other)))


def contained(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, key, n_words) per document row, and (doc_id, key, start, length, item_id) of the matched windows.

    key is the document's text hash, start counts its words from 0.
    """
    every = staged(windows(items, window, shingle), "windows")
    entries = every.select("item_id", "words", F.explode("shingles").alias("e")).select("words", "e.*").distinct()
    times = staged(_frequencies(docs, entries), "times")
    size = F.size("ordered")
    needed = F.ceil(F.lit(share) * size - 1e-9).cast("int")
    ordered = (
        entries.join(times, "g", "left")
        .groupBy("words")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "g", "place", "width"))).alias("ordered"))
        .select("words", needed.alias("needed"), size.alias("shingles"), F.explode(F.slice("ordered", F.lit(1), size - needed + 1)).alias("e"))
        .select("words", "needed", "shingles", "e.g", "e.place", "e.width")
    )
    prefixes = staged(ordered, "prefixes")
    rows = staged(_probed(docs, prefixes, window), "probed")
    probes = rows.select("doc_id", "key", "n_words", F.explode("probes").alias("p")).select("doc_id", "key", "n_words", "p.*").distinct()
    met = probes.join(prefixes, "g").withColumn("length", F.size("words").cast("long"))
    begin = F.col("pos") - F.col("place")
    exact = share >= 1
    if exact:
        met = met.withColumn("start", begin)
    else:
        slack = F.col("shingles") - F.col("needed") + F.col("width")
        met = met.withColumn("start", F.explode(F.sequence(F.greatest(begin - slack, F.col("pos") + F.col("width") - F.col("length")), F.least(begin + slack, F.col("pos")))))
    met = met.where((F.col("start") >= F.col("from")) & (F.col("start") + F.col("length") <= F.col("n_words")))
    there = F.slice("around", (F.col("start") - F.col("from") + 1).cast("int"), F.col("length").cast("int"))
    held = there == F.col("words") if exact else _shared(F.col("words"), there, F.col("width")) >= F.col("needed")
    found = met.where(held).select("doc_id", "key", "start", "length", "words").distinct()
    named = every.select("item_id", "words").distinct()
    return rows.select("doc_id", "key", "n_words"), found.join(named, "words").select("doc_id", "key", "start", "length", "item_id")


def covered(spans: Column) -> Column:
    """Words under any of an array of (start, length) structs."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        more = F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], s["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + more).alias("n"))

    return F.aggregate(F.sort_array(spans), start, step, lambda acc: acc["n"])


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, item_ids) per document row: words under a match, and the items matched."""
    rows, found = contained(docs, items, window)
    per = found.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("item_ids")
    )
    per = per.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), covered(F.col("spans")).alias("n_hit"), "item_ids")
    out = rows.join(per, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))
