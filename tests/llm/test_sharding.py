"""Sharding: exact sizes, gapless slots, every row once, and the drawn law."""

import zlib
from collections import Counter

import numpy as np
from muster.llm.sharding import _draw, matrix, shuffled


def held(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, shard int")
    return shuffled(docs, **kw).collect()


def check(got, rows, shards):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    counts = Counter(r.shard for r in got)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = shuffled(docs, cell_rows=10).collect()
    check(got, rows, 16)
    assert sorted(map(tuple, shuffled(docs, cell_rows=10).collect())) == sorted(map(tuple, got))
    first = [r.doc_id for r in sorted((r for r in got if r.shard == 0), key=lambda r: r.slot)]
    assert first != sorted(first)


def test_defined_cases(spark):
    rows = [(1, None), (1, None), (None, ""), (None, ""), (2, "é" * 100_000), (3, "same"), (4, "same")] + [(9, "same")] * 40
    check(held(spark, rows), rows, 16)
    check(held(spark, rows[:3]), rows[:3], 16)
    assert held(spark, []) == []


def test_matrix_has_exact_sums_and_the_right_mean():
    counts = np.array([7, 0, 13, 100, 1])
    drawn = [matrix(counts, 4, seed) for seed in range(400)]
    for m in drawn:
        assert (m.sum(axis=1) == counts).all() and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1 and (m >= 0).all()
    mean = np.mean(drawn, axis=0)
    assert np.abs(mean - counts[:, None] / 4).max() < 0.6
    big = matrix(np.array([3 * 10**9, 10**9]), 3, 1)
    assert big.sum(axis=1).tolist() == [3 * 10**9, 10**9] and np.ptp(big.sum(axis=0)) <= 1


def test_large_draws_follow_the_law():
    rng = np.random.default_rng(5)
    got = np.array([_draw(rng, 4 * 10**9, 6 * 10**9, 1000) for _ in range(4000)])
    assert abs(got.mean() - 400) < 1.5 and abs(got.std() - (1000 * 0.24) ** 0.5) < 0.8
    assert _draw(rng, 10**9, 5, 10**9) >= 10**9 - 5
