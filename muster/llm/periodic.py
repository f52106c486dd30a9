"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of consecutive words with smallest period q, of at least max(LEAST, TIMES * q) words, that no neighbouring
word extends. Each of its words therefore stands in it TIMES times or more. So a word found fewer times in its
segment is in no run that lies in the segment: it splits it. Pieces of fewer than LEAST words go, words are counted
anew within each piece, and this is repeated until nothing splits any more. All texts of a slice are split at once.

Surviving segments are scanned lag by lag, lags Q to 2Q - 1 together. A run of such a period holds a block of Q words, at a
place that is a multiple of Q, that stands again one period later, so only those blocks are compared with all of their lags, by
hashes that double in width from band to band. Matching neighbours form a chain, whose two ends are then
extended word by word. Each band costs as much as its segments are long, whatever they hold: n words take n * log n steps. A block inside a
run of a smaller period is not scanned again; its longer lags are multiples of that period.

Words are compared by 64-bit hashes. Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed
text. Texts of any length are taken whole, as one slice. Repeated rows and rows with a null doc_id are worked on like any other.
Extra columns are not read; an empty table gives no rows. Nothing is shuffled, so hot keys do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm import texts

LEAST, TIMES = 6, 4
#: Elements compared at once, which bounds memory beside the words themselves.
AT_ONCE = 1 << 20
_RUNS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS_SQL = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _stretches(pos: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Where a new segment begins: at a gap between places and at a border between segments."""
    return np.concatenate([[True], (np.diff(pos) != 1) | (np.diff(seg) != 0)]) if len(pos) else np.zeros(0, bool)


def surviving(h: np.ndarray, seg: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words left when no segment can be split any more, and the number of each one's segment."""
    pos = np.arange(len(h))
    while len(pos):
        _, which, n = np.unique(texts.mix(h[pos] + texts.mix(seg.astype(np.uint64))), return_inverse=True, return_counts=True)
        keep = n[which] >= times
        pos, seg, before = pos[keep], seg[keep], len(pos)
        seg = np.cumsum(_stretches(pos, seg))
        size = np.bincount(seg, minlength=1)
        long = size[seg] >= least
        pos, seg = pos[long], seg[long]
        if len(pos) == before:
            break
    return pos, seg


def _extent(x: np.ndarray, at: np.ndarray, lag: np.ndarray, step: int, room: np.ndarray, width: int) -> np.ndarray:
    """How many words on from `at`, in direction `step`, equal those a lag further; at most `room`, which is below `width`."""
    out = np.zeros(len(at), np.int64)
    if width <= 1:
        return out
    k = np.arange(width - 1)
    for lo in range(0, len(at), max(1, AT_ONCE // width)):
        part = slice(lo, lo + max(1, AT_ONCE // width))
        i = at[part, None] + step * k
        inside = k < room[part, None]
        i = np.where(inside, i, 0)
        same = inside & (x[i] == x[np.where(inside, i + lag[part, None], 0)])
        out[part] = np.where(same.all(axis=1), width - 1, same.argmin(axis=1))
    return out


def _candidates(block: np.ndarray, anchors: np.ndarray, ends: np.ndarray, covered: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor index, lag) wherever an anchor's block stands again lag words later and no shorter run holds both."""
    lags = np.arange(band, 2 * band)
    which, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, AT_ONCE // band)
    for lo in range(0, len(anchors), step):
        a, end = anchors[lo : lo + step, None], ends[lo : lo + step, None]
        inside = a + lags + band <= end
        i, j = np.nonzero(inside & (block[np.where(inside, a + lags, 0)] == block[a]) & (covered[lo : lo + step, None] < a + lags + band))
        which.append(i + lo)
        found.append(lags[j])
    return np.concatenate(which), np.concatenate(found)


def lag_scan(x: np.ndarray, seg: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, end, period) of all runs in a sequence of word hashes that is cut into numbered segments."""
    runs = np.zeros((0, 3), np.int64)
    if not len(x):
        return runs
    first = np.flatnonzero(np.concatenate([[True], np.diff(seg) != 0]))
    last = np.append(first[1:], len(x))
    band, block = 1, x
    while True:
        fits = last - first >= max(least, times * band)
        if not fits.any():
            return runs
        count = np.where(fits, (last - first - 2 * band) // band + 1, 0)
        begin = np.repeat(first, count)
        anchors = begin + band * (np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count))
        ends = np.repeat(last, count)
        covered = np.full(len(anchors), -1)
        if len(runs):
            order = np.argsort(runs[:, 0], kind="stable")
            reach = np.maximum.accumulate(runs[order, 1])
            k = np.searchsorted(runs[order, 0], anchors, "right")
            covered = np.where(k > 0, reach[k - 1], -1)
        open_ = covered < anchors + 3 * band - 1
        begin, anchors, ends, covered = begin[open_], anchors[open_], ends[open_], covered[open_]
        which, lag = _candidates(block, anchors, ends, covered, band)
        if len(which):
            order = np.lexsort((which, lag))
            which, lag = which[order], lag[order]
            at = anchors[which]
            new = np.concatenate([[True], (np.diff(lag) != 0) | (np.diff(at) != band)])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(at)) - 1
            q = lag[head]
            may = at[tail] - at[head] + q + 3 * band - 2 >= np.maximum(least, times * q)
            head, tail, q = head[may], tail[may], q[may]
            left = at[head] - 1
            right = at[tail] + band
            start = at[head] - _extent(x, left, q, -1, at[head] - begin[which[head]], band)
            end = right + q + _extent(x, right, q, 1, ends[which[head]] - q - right, band)
            long = end - start >= np.maximum(least, times * q)
            runs = np.concatenate([runs, np.stack([start, end, q], axis=1)[long]])
        if len(block) <= band:
            return runs
        block = texts.mix(block[:-band] * texts._BASE + block[band:])
        band *= 2


def runs_of(t: texts.Texts) -> tuple[texts.Words, np.ndarray]:
    """The words of a slice, and rows (text, start, length, period) of all runs, in the order of text, start and period."""
    w = texts.words(t, texts.SPACED)
    h = texts.ranges(texts.prefix(t.data), w.start, w.end)
    pos, seg = surviving(h, w.text)
    found = lag_scan(h[pos], seg)
    start = pos[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    who = np.searchsorted(w.by, start, "right") - 1
    out = np.stack([who, start - w.by[who], found[:, 1] - found[:, 0], found[:, 2]], axis=1) if len(found) else np.zeros((0, 4), np.int64)
    return w, out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(t: texts.Texts, w: texts.Words, runs: np.ndarray) -> pa.Array:
    """Each text's words, one space between them, without those that repeat a run's first period."""
    n = len(w.start)
    change = np.zeros(n + 1, np.int64)
    base = w.by[runs[:, 0]] + runs[:, 1]
    np.add.at(change, base + runs[:, 3], 1)
    np.add.at(change, base + runs[:, 2], -1)
    keep = np.flatnonzero(np.cumsum(change[:n]) == 0)
    size = len(t.data)
    mark = np.zeros(size + 1, np.int64)
    mark[w.start[keep]] += 1
    mark[w.end[keep]] -= 1
    held = np.cumsum(mark[:size]) > 0
    text = w.text[keep]
    spaced = w.end[keep[:-1][text[1:] == text[:-1]]]  # another word of this text follows, so a separator stands here
    data = t.data.copy()
    data[spaced] = 0x20
    held[spaced] = True
    off = np.concatenate([[0], np.cumsum(held)])[t.off].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(t), pa.py_buffer(off.tobytes()), pa.py_buffer(data[held].tobytes())).cast(pa.string())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row: runs are structs (start, length, period) in word numbers, by start, then period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts.slices(b.column(1)):
                w, found = runs_of(t)
                off = np.searchsorted(found[:, 0], np.arange(len(t) + 1)).astype(np.int32)
                fields = [pa.array(np.ascontiguousarray(found[:, k])) for k in (1, 2, 3)]
                listed = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(fields, fields=list(_RUNS)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(t.first, len(t)), pa.array(np.diff(w.by).astype(np.int64)), listed, collapsed(t, w, found)],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {_RUNS_SQL}, collapsed string")


def longest(runs: Column) -> Column:
    """The run with the greatest length; of equals the smallest start, then period. Null where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def listed(runs: Column) -> Column:
    """One line `start,length,period` per run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by crc32 of the id, say one stretch of their words again and again to the end.

    Word i >= a becomes word a + (i - a) % p, where g = crc32 div 10, a = g % n and p = 1 + (n - a) div (3 + g % 8). The others, and rows with
    a null doc_id, are as they were.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    text = F.col("text").cast("string")
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.floor(h / 10).alias("g"), words.alias("w"))
    rows = rows.withColumn("a", F.expr("CAST(CASE WHEN size(w) > 0 THEN g % size(w) END AS INT)"))
    rows = rows.withColumn("p", F.expr("CAST(1 + (size(w) - a) div (3 + g % 8) AS INT)"))
    again = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p")))), " ")
    return rows.select("doc_id", F.when(F.size("w") > 0, again).otherwise(F.col("text")).alias("text"))
