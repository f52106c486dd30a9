"""Near duplicates: a multi-index Hamming join of b-bit MinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct word shingles as 64-bit hashes. Equal sets are one node. A node's signature has
`symbols` MinHash values of 16 bits; two sets of similarity s differ in a symbol with probability just under 1 - s.
The signature is split into chunks. If two signatures differ in at most `distance` symbols and there are more than
distance / 2 chunks, some chunk holds at most one error; so each chunk is filed once for every symbol left out, and every
pair within the distance shares a file. With 40 symbols, distance 19 and chunks of 4, sets of similarity 0.8 lie within the
distance with probability 0.99997, and no file of near copies is paired out: a file's nodes are paired with a few
pivots of the file first, verified links give nodes labels of what they reach, and only nodes without their file's main label are then
compared, in blocks, with the rest of the file. Every pair within the distance is either verified on the full sets or
already joined by verified links, so components come out whole.

Defined cases: null text, empty text and texts without words have an empty set and are linked with nothing. Texts with fewer
words than a shingle are one shingle. Repeated rows and rows with equal texts share a node. Rows with a null doc_id take
part; a component's id is its smallest doc_id that is not null, else null. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm import bitmaps, texts
from muster.llm.common import staged, text_key
from muster.llm.components import components, labels

SYMBOLS, CHUNK, DISTANCE = 40, 4, 19
BLOCK, BLOCK_ITEMS = 1024, 500_000
#: A file's nodes are linked to its smallest node in each of these orders (by id XOR the number).
PIVOTS = [0, -1, 0x2AAAAAAAAAAAAAAA, 0x1999999999999999]
_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_SIDE = np.uint64(0xA5A5F00DBEEF1234)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each slice its first row and, for each text, the sorted distinct shingle hashes."""
    for t in texts.slices(column):
        t.data = texts.LOWER[t.data]
        w = texts.words(t, texts.SPACED)
        h = texts.ranges(texts.prefix(t.data), w.start, w.end)
        grams, n = texts.runs(h, width), np.diff(w.by)
        out = []
        for i in range(len(t)):
            a, k = w.by[i], n[i]
            if k >= width:
                out.append(np.unique(grams[a : a + k - width + 1]))
            else:
                out.append(texts.runs(h[a : a + k], k) if k else np.zeros(0, np.uint64))
        yield t.first, out


def _reduced(op: np.ufunc, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return op.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def fingerprints(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes that name a set; None for the empty one."""
    size = np.array([len(s) for s in sets])
    full = np.flatnonzero(size)
    out: list[bytes | None] = [None] * len(sets)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        marks = np.stack([_reduced(np.add, texts.mix(flat), starts), _reduced(np.add, texts.mix(flat ^ _SIDE), starts)], axis=1)
        for i, m in zip(full, marks):
            out[i] = m.tobytes()
    return out


def signatures(sets: list[np.ndarray]) -> list[bytes | None]:
    size = np.array([len(s) for s in sets])
    full = np.flatnonzero(size)
    out: list[bytes | None] = [None] * len(sets)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        sig = np.empty((len(full), SYMBOLS), np.uint16)
        for k in range(SYMBOLS):
            x = flat * _MULT[k] + _ADD[k]
            x ^= x >> np.uint64(32)
            sig[:, k] = (_reduced(np.minimum, x, starts) * _MULT[0] >> np.uint64(48)).astype(np.uint16)
        for i, s in zip(full, sig):
            out[i] = s.tobytes()
    return out


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, n_shingles, fp, sig) per row; fp and sig are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, sets in shingle_sets(b.column(2), width):
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, n), b.column(1).slice(first, n), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(fingerprints(sets), pa.binary()), pa.array(signatures(sets), pa.binary())],
                    names=["doc_id", "key", "n_shingles", "fp", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n_shingles long, fp binary, sig binary")


def files(nodes: DataFrame) -> DataFrame:
    """(file, id): each node in each of its files. A file is a chunk, the place of the symbol left out, and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(n, SYMBOLS).astype(np.uint64)
            ids = b.column(0)
            for c in range(SYMBOLS // CHUNK):
                part = sig[:, c * CHUNK : (c + 1) * CHUNK]
                for left_out in range(CHUNK):
                    key = np.full(n, c * CHUNK + left_out, np.uint64)
                    for k in range(CHUNK):
                        if k != left_out:
                            key = (key << np.uint64(16)) | part[:, k]
                    yield pa.RecordBatch.from_arrays([pa.array(texts.int64(key)), ids], names=["file", "id"])

    return nodes.select("id", "sig").mapInArrow(run, "file long, id long")


def _near(x: np.ndarray, y: np.ndarray, place: int) -> np.ndarray:
    """Pairs of rows within the distance whose first common file is this one, as an index matrix. `place` is the file's
    chunk and symbol left out."""
    same = x[:, None, :] == y[None, :, :]
    i, j = np.nonzero(same.sum(axis=2, dtype=np.uint8) >= SYMBOLS - DISTANCE)
    same = same[i, j].reshape(-1, SYMBOLS // CHUNK, CHUNK)
    equal = same.sum(axis=2)
    chunk = (equal >= CHUNK - 1).argmax(axis=1)
    left_out = np.where(equal[np.arange(len(i)), chunk] == CHUNK, 0, (~same[np.arange(len(i)), chunk]).argmax(axis=1))
    return np.stack([i, j], axis=1)[chunk * CHUNK + left_out == place]


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures are within the distance and whose sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if n:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(n, SYMBOLS) for i in (2, 3))
                ok = pa.array((x != y).sum(axis=1) <= DISTANCE)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["a", "b"])

    one = nodes.select(F.col("id").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na"))
    two = nodes.select(F.col("id").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb"))
    both = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, counted on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(100 * shared >= percent * (len(both) - shared))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    one = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    two = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ia", "ib").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, items): full sets of the wanted nodes, from their texts; a bitmap of text keys passes over the other texts."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(bitmaps.build(wanted, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            texts_in = b.column(1).filter(pa.array(bitmaps.has(held.value, keys)))
            for _, sets in shingle_sets(texts_in, width):
                out = []
                for fp, s in zip(fingerprints(sets), sets):
                    if fp is not None and fp not in seen:
                        seen.add(fp)
                        out.append((fp, s.tobytes()))
                yield pa.RecordBatch.from_arrays([texts.binary([x[0] for x in out]), texts.binary([x[1] for x in out])], names=["fp", "items"])

    rows = docs.select(text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "fp binary, items binary")
    return found.join(wanted.select("fp", "id"), "fp").groupBy("id").agg(F.first("items").alias("items"))


def _rest(filed: DataFrame, nodes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(row, a, b): per pair of blocks of a file, the pairs within the distance that no verified link joins yet.

    Nodes outside the component of their file's first pivot are compared with the whole file, block against block; a
    file that is all one component is done. Blocks are bounded in nodes and in the size of their sets. The pairs of a row
    are two arrays, so what is passed on is a row per pair of blocks.
    """
    state = nodes.join(groups, nodes["id"] == groups["node"], "left").select(
        "id", "sig", "n", F.coalesce("component", "id").alias("component")
    )
    rows = filed.select("file", "id", "pivot0").join(state, "id")
    main = rows.where("id = pivot0").select("file", F.col("component").alias("main"))
    sizes = rows.groupBy("file").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_ITEMS)).alias("blocks"))
    marked = rows.join(main.join(sizes, "file"), "file").withColumn("outside", F.col("component") != F.col("main"))
    member = F.struct("id", "sig", "n", "component", "outside")
    blocks = marked.groupBy("file", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")).agg(
        F.collect_list(member).alias("everyone"), F.collect_list(F.when(F.col("outside"), member)).alias("outside")
    )
    left = blocks.where(F.size("outside") > 0).select("file", "outside")
    right = blocks.select("file", "everyone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(list_scalar):
            v = list_scalar.values
            sig = np.frombuffer(b"".join(v.field("sig").to_pylist()), np.uint16).reshape(len(v), SYMBOLS)
            return sig, *(v.field(k).to_numpy(zero_copy_only=False) for k in ("id", "n", "component", "outside"))

        for batch in batches:
            one, two = [], []
            for file, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                (sx, ix, nx, cx, _), (sy, iy, ny, cy, oy) = columns(x), columns(y)
                a, b = [], []
                for k in range(0, len(ix), 128):
                    i, j = _near(sx[k : k + 128], sy, file >> 48).T
                    i = i + k
                    once = ~oy[j] | (ix[i] < iy[j])  # two nodes outside meet in both directions
                    ok = once & (cx[i] != cy[j]) & (100 * np.minimum(nx[i], ny[j]) >= percent * np.maximum(nx[i], ny[j]))
                    a.append(ix[i[ok]])
                    b.append(iy[j[ok]])
                a, b = np.concatenate(a), np.concatenate(b)
                if len(a):
                    one.append(a)
                    two.append(b)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(one, kind), pa.array(two, kind)], names=["a", "b"])

    found = left.join(right, "file").select("file", "outside", "everyone").mapInArrow(run, "a array<long>, b array<long>")
    return found.withColumn("row", F.monotonically_increasing_id())


def _prefixes(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """For each set the part of its rarest items of which similar sets share one, without the items that are in no other's part.

    Items are ordered by how many of the sets hold them. Sets of n items that are similar enough share at least percent of n, so
    one of the first n - ceil(percent of n) + 1 of either is among the other's.
    """
    size = np.array([len(x) for x in sets])
    _, item, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    owner, rank = np.repeat(np.arange(len(size)), size), rank[item]
    rank = rank[np.lexsort((rank, owner))]
    place = np.arange(len(rank)) - np.repeat(np.cumsum(size) - size, size)
    first = place < np.repeat(size - (size * percent + 99) // 100 + 1, size)
    rank, owner = rank[first], owner[first]
    shared = np.bincount(rank)[rank] > 1
    return np.split(rank[shared], np.cumsum(np.bincount(owner[shared], minlength=len(size)))[:-1])


def _confirmed_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among each row's pairs, by their full sets: enough of them to join whatever the row's links join.

    Where a row has more pairs than nodes, only pairs that share one of their rarest shingles are counted, so texts that hold one long
    passage and little else in common cost no count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = [], []
            for r in range(batch.num_rows):
                a, b, held = (batch.column(c)[r] for c in range(3))
                ids = held.values.field("id").to_numpy()
                items = {i: np.frombuffer(x.as_buffer(), np.uint64) for i, x in zip(ids.tolist(), held.values.field("items"))}
                up = {i: i for i in items}

                def root(i: int) -> int:
                    while up[i] != i:
                        up[i] = i = up[up[i]]
                    return i

                a, b = a.values.to_numpy(), b.values.to_numpy()
                part = dict(zip(items, _prefixes(list(items.values()), percent))) if len(a) > len(items) else None
                if part:
                    live = np.array([i for i, p in part.items() if len(p)], np.int64)
                    may = np.isin(a, live) & np.isin(b, live)
                    a, b = a[may], b[may]
                if not len(a):
                    continue
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                cuts = np.flatnonzero(np.diff(a, prepend=a[0] - 1))
                for lo, hi in zip(cuts, [*cuts[1:], len(a)]):
                    i, own = int(a[lo]), items[int(a[lo])]
                    others = [j for j in b[lo:hi].tolist() if root(j) != root(i)]
                    if part and others:
                        long = np.array([len(part[j]) for j in others])
                        common = np.isin(np.concatenate([part[j] for j in others]), part[i])
                        others = [j for j, hit in zip(others, np.logical_or.reduceat(common, np.cumsum(long) - long)) if hit]
                    if not others:
                        continue
                    size = np.array([len(items[j]) for j in others])
                    flat = np.concatenate([items[j] for j in others])
                    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                    shared = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(size) - size)
                    for j in np.flatnonzero(100 * shared >= percent * (len(own) + size - shared)).tolist():
                        if root(others[j]) != root(i):
                            up[root(others[j])] = root(i)
                            one.append(i)
                            two.append(others[j])
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    wanted = rows.select("row", F.explode(F.array_distinct(F.concat("a", "b"))).alias("id"))
    held = wanted.join(sets, "id").groupBy("row").agg(F.collect_list(F.struct("id", "items")).alias("held"))
    return rows.join(held, "row").select("a", "b", "held").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) per row of `docs`; key is the row's text hash."""
    rows = staged(sketches(docs, width), "sketches")
    nodes = staged(
        rows.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc"), F.min("key").alias("key"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    every = files(nodes)
    ends = every.groupBy("file").agg(*[F.min(F.col("id").bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)).alias(f"pivot{k}") for k, x in enumerate(PIVOTS)], F.count(F.lit(1)).alias("members")).where("members > 1")
    filed = staged(every.join(ends, "file"), "files")
    pivots = F.array_distinct(F.array(*[f"pivot{k}" for k in range(len(PIVOTS))]))
    star = filed.select("id", F.explode(pivots).alias("pivot")).where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
    first = staged(_close(star.distinct(), nodes, percent), "pairs")
    wanted = nodes.join(filed.select("id").distinct(), "id").select("id", "fp", "key")
    sets = staged(_sets(docs, wanted, width), "sets")
    links = staged(_confirmed(first, sets, percent), "confirmed")
    known = staged(labels(links), "labels")
    second = staged(_rest(filed, nodes, known, percent), "rest")
    groups = components(links.union(_confirmed_blocks(second, sets, percent)), known)
    named = nodes.join(groups, nodes["id"] == groups["node"], "left").select("fp", "doc", F.coalesce("component", "id").alias("component"))
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    final = named.join(least, "component").select("fp", "component_id")
    out = rows.join(final, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
