"""Best-fit packing of tokenised documents into sequences of at most `capacity` tokens.

A document is its token ids and one end id. Only longer ones than a sequence are cut: what is left over comes first, then
whole sequences. Pieces and gaps are sorted by size. A round takes the largest pieces left; a sweep over the sorted
gaps finds each piece's successor, the smallest gap that holds it; pieces that want gaps of one size are dealt to them by rank, the
gaps shrink, and the next round follows. Sizes are whole numbers up to the capacity, so equal sizes are one run, and a round's
sweep is over runs: the driver holds at most `capacity` runs of pieces and of gaps, never a row. It returns "flows": the pieces
of one length from rank to rank go to the sequences from number to number at one offset. Ranks within a run are computed by Spark
in blocks, and each task looks its pieces up in the flows, of which there are at most capacity squared / 2 and in
practice some thousands.

Defined cases: null and empty texts are one end id. "<|endoftext|>" in a text is the tokenizer's added token. Repeated rows are packed each. Ties in length go by doc_id, then piece, then
checksum. A very long text is many pieces. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm import texts, tokenizing
from muster.llm.common import ranked, staged

CAPACITY, END = 2048, 0


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, block) of every document; block is the task that made the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for b in batches:
            ids_of = b.column(0)
            for t in texts.slices(b.column(1)):
                ids, by = tokenizing.encode(t, vocabulary, tokenizing.ADDED)
                rows, piece, start, length, crc = [], [], [], [], []
                for i in range(len(t)):
                    own = np.append(ids[by[i] : by[i + 1]], np.uint32(end)).astype("<u4")
                    a, z = 0, len(own) % capacity or min(capacity, len(own))
                    k = 0
                    while a < len(own):
                        rows.append(t.first + i)
                        piece.append(k)
                        start.append(a)
                        length.append(z - a)
                        crc.append(zlib.crc32(own[a:z].tobytes()))
                        a, z, k = z, z + capacity, k + 1
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array([block] * n, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "block"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, block long")


class Gaps:
    """Open sequences by gap size: a sorted list of sizes, and for each its runs of sequence numbers."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if size not in self.runs:
                bisect.insort(self.sizes, size)
                self.runs[size] = []
            self.runs[size].append((first, n))

    def take(self, size: int, most: int) -> tuple[int, int]:
        """The last run of this size, or its first `most` sequences."""
        first, n = self.runs[size].pop()
        if n > most:
            self.runs[size].append((first + most, n - most))
            n = most
        if not self.runs[size]:
            del self.runs[size]
            self.sizes.remove(size)
        return first, n

    def successor(self, size: int) -> int | None:
        k = bisect.bisect_left(self.sizes, size)
        return self.sizes[k] if k < len(self.sizes) else None


def flows(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset) sorted by length and rank; a flow ends where the next begins."""
    gaps, out, opened = Gaps(), [], 0

    def deal(length: int, rank: int, left: int, first: int, n: int, gap: int) -> int:
        """Fills sequences first .. first + n - 1 with as many pieces each as fit, and puts back what stays open."""
        each = gap // length
        full = min(n, left // each)
        for layer in range(each if full else 0):
            out.append((length, rank, first, capacity - gap + layer * length))
            rank += full
        left -= full * each
        gaps.add(gap - each * length, first, full)
        if full < n and left:
            for layer in range(left):
                out.append((length, rank + layer, first + full, capacity - gap + layer * length))
            gaps.add(gap - left * length, first + full, 1)
            full, left = full + 1, 0
        gaps.add(gap, first + full, n - full)
        return left

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rank, gap = counts[length] - left, gaps.successor(length)
            each = (gap or capacity) // length
            wanted = -(-left // each)
            if gap is None:
                first, n, gap = opened, wanted, capacity
                opened += wanted
            else:
                first, n = gaps.take(gap, wanted)
            left = deal(length, rank, left, first, n, gap)
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): each piece once."""
    spark = docs.sparkSession
    rows = staged(pieces(docs, vocabulary, capacity, end), "pieces")
    counts = dict(rows.groupBy("length").agg(F.count(F.lit(1))).collect())
    held = spark.sparkContext.broadcast(flows(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = held.value
        keys = plan[:, 0] << 48 | plan[:, 1]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(keys, length << 48 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(plan[k, 2] + rank - plan[k, 1]), pa.array(plan[k, 3])],
                names=[*b.schema.names[:5], "sequence_id", "offset"],
            )

    placed = ranked(rows, ["length"], "block", ["doc_id", "piece", "ids_crc32"], "rank")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, schema)
