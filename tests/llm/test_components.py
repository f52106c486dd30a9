"""Components against union-find."""

import random

import pytest
from muster.llm.components import components, labels


def brute(links):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
    groups = {}
    for x in up:
        groups.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def result(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.component, []).append(r.node)
    return sorted(map(sorted, groups.values()))


rng = random.Random(1)
ids = rng.sample(range(-10**12, 10**12), 80)
CASES = {
    "chain": [(k, k + 1) for k in range(60)], "shuffled chain": list(zip(ids, ids[1:])), "star": [(7, k) for k in range(100, 160)],
    "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(60)], "loops and copies": [(1, 1), (1, 2), (2, 1), (1, 2), (3, 4)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = [(a, b) for a, b in CASES[name]]
    df = spark.createDataFrame(links, "a long, b long")
    want = brute([(a, b) for a, b in links if a != b])
    assert result(components(df)) == want
    part = df.where("a <> b").limit(len(links) // 2).cache()
    assert result(components(df, labels(part))) == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
