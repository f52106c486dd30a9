"""Near duplicates against brute force over full sets, and the defined cases."""

import re
from itertools import combinations

import numpy as np
import pytest
from muster.llm import near
from muster.llm.near import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


def shingles(text, width):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def brute(rows, width=4, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = [(d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted([(*r, r[0] == r[2]) for r in out], key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_agrees_with_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(near_duplicates(docs, width=4)) == brute(rows)


def test_group_of_near_copies_keeps_every_link(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(400):
        w = list(base)
        for k in range(d % 7):
            w[(d * 13 + k * 31) % 120] = f"x{d}_{k}"
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(docs, width=4)) == brute(rows)


def test_defined_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, long), (7, long + " end"), (7, "one two"),
            (None, "one two"), (None, None), (8, "É two"), (9, "é two")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, file long, id string")
    assert result(near_duplicates(docs, width=4)) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("percent", [60, 100])
def test_other_thresholds_stay_within_the_distance(spark, percent):
    rows = [(i, " ".join(f"w{j + (i // 2) * 1000}" for j in range(200)) + (" tail" if i % 2 else "")) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(docs, width=5, percent=percent)) == brute(rows, 5, percent)


def _around_a_passage(n, shared=150, own=70):
    rows = [(d, " ".join([f"s{k}" for k in range(shared)] + [f"d{d}w{k}" for k in range(own)])) for d in range(n)]
    return rows + [(n + d, t + " tail") for d, t in rows[:5]]


def test_texts_around_one_long_passage(spark):
    rows = _around_a_passage(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(docs, width=4)) == brute(rows)


def test_parts_of_similar_sets_share_an_item():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(150)]
    for percent in (50, 80, 100):
        parts = near._prefixes(sets, percent)
        for (x, p), (y, q) in combinations(zip(sets, parts), 2):
            both = len(np.intersect1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both):
                assert len(np.intersect1d(p, q))


def test_a_long_passage_alone_leaves_nothing_to_count():
    sets = [np.array([*range(150), *range(1000 * k + 1000, 1000 * k + 1070)], np.uint64) for k in range(200)]
    assert sum(len(p) for p in near._prefixes(sets, 80)) == 0
