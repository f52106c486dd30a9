"""The weak-label model: estimation on a known truth, held-out accuracy, and the defined cases."""

from collections import Counter

import numpy as np
from muster.llm import weak


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(60_000) < 0.2
    yes_if = np.array([[0.02, 0.8], [0.05, 0.7], [0.01, 0.5]])
    votes = np.stack([np.where(rng.random(len(truth)) < 0.3, weak.NONE, (rng.random(len(truth)) < np.where(truth, y[1], y[0])).astype(int)) for y in yes_if], axis=1)
    counted = Counter(map(tuple, votes.tolist()))
    patterns = np.array(list(counted))
    share, chance, post = weak.accuracies(patterns, np.array(list(counted.values()), float))
    assert abs(share - 0.2) < 0.02
    among = chance[:, :, weak.YES] / (chance[:, :, weak.YES] + chance[:, :, weak.NO])
    assert np.abs(among.T - yes_if).max() < 0.04
    known = dict(zip(map(tuple, patterns.tolist()), post))
    assert np.mean((np.array([known[tuple(v)] for v in votes.tolist()]) > 0.5) == truth) > 0.93


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    said = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    got = {r.doc_id: r for r in weak.scored(docs, labels.where("doc_id % 3 > 0")).collect()}
    assert len(got) == docs.count()
    hidden = [d for d in said if d % 3 == 0]
    clean = [d for d in hidden if said[d] == (1, 0)]
    junk = [d for d in hidden if said[d][0] == 0]
    toxic = [d for d in hidden if said[d][1] == 1]
    assert np.mean([got[d].kept for d in clean]) >= 0.99
    assert np.mean([not got[d].kept for d in junk]) >= 0.9
    assert np.mean([not got[d].kept for d in toxic]) >= 0.8


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "some words of an ordinary kind"), (4, "w " * 100_000), (5, "idiot moron scum " * 5), (5, "idiot moron scum " * 5)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, key string, p_junk double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = weak.scored(docs, none).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, _ in rows)
    assert all(r.kept for r in got if r.doc_id in (1, 2, 3, None))
    some = spark.createDataFrame([(5, 1, 1), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert not any(r.kept for r in weak.scored(docs, some).collect() if r.doc_id == 5)
    assert weak.scored(docs.limit(0), none).collect() == []
