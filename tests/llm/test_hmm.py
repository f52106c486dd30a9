"""The hidden Markov model: base score by brute force, recursions against sums over all state paths, held-out gain."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from muster.llm import hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def base(rows):
    c = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for d, text in rows:
        t = tokens(text)
        out.append((d, held(d), len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), 6)))
    return sorted(out, key=repr)


def result(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)


def test_documents_base_score_and_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = hmm.scored(docs).collect()
    assert result(got) == base(rows)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "One two one"), (3, "two " * 20_000), (4, "unseen")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, word string")
    got = hmm.scored(docs).collect()
    assert result(got) == base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.scored(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_held_out_documents(spark):
    ids = [d for d in range(60) if held(d)]
    rows = [(d, "a b c") for d in ids]
    got = hmm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and all(math.isfinite(r.score) for r in got)


def paths(m, seen):
    """Probability and expected counts by summing over every path."""
    s, total = len(m.start), 0.0
    starts, moves, emits = np.zeros(s), np.zeros((s, s)), np.zeros_like(m.emit)
    for p in itertools.product(range(s), repeat=len(seen)):
        w = m.start[p[0]] * m.emit[p[0], seen[0]]
        for a, b, x in zip(p, p[1:], seen[1:]):
            w *= m.move[a, b] * m.emit[b, x]
        total += w
        starts[p[0]] += w
        for a, b in zip(p, p[1:]):
            moves[a, b] += w
        for a, x in zip(p, seen):
            emits[a, x] += w
    return total, starts / total, moves / total, emits / total


def model(states, width, seed):
    rng = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return hmm.Model(norm(rng.random(states)), norm(rng.random((states, states))), norm(rng.random((states, width))))


def test_recursions_equal_sums_over_paths():
    rng = np.random.default_rng(4)
    m = model(3, 5, 1)
    texts = [rng.integers(0, 5, n) for n in (1, 2, 6, 4, 1)]
    n = np.array([len(t) for t in texts])
    seen = np.concatenate(texts)
    want = [paths(m, t) for t in texts]
    assert np.allclose(hmm.likelihoods(m, seen, n), [math.log10(w[0]) for w in want])
    starts, moves, emits, log = hmm.expected(m, seen, hmm.cut(n, np.cumsum(n) - n))
    for got, k in ((starts, 1), (moves, 2), (emits, 3)):
        assert np.allclose(got, sum(w[k] for w in want))
    assert math.isclose(log, sum(math.log(w[0]) for w in want))


def test_likelihood_of_long_texts_is_exact():
    rng = np.random.default_rng(9)
    m = model(4, 50, 2)
    n = np.array([5 * hmm.RUN + 3, 1, hmm.RUN, hmm.RUN + 1])
    seen = rng.integers(0, 50, n.sum())
    want, at = [], 0
    for k in n:
        a, log = m.start * m.emit[:, seen[at]], 0.0
        for x in seen[at + 1 : at + k]:
            log += math.log10(a.sum())
            a = (a / a.sum()) @ m.move * m.emit[:, x]
        want.append(log + math.log10(a.sum()))
        at += k
    assert np.allclose(hmm.likelihoods(m, seen, n), want)
