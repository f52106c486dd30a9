"""Periodic runs against a scan of every lag, on small alphabets, planted repeats and odd texts."""

import random
import re
import zlib

import numpy as np
from muster.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """(start, length, period) of every run, by comparing each word with the one q words on, for all q."""
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in found.items())


def left(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_text(rng):
    w = [rng.choice("abcdefghé"[: rng.choice([1, 2, 3, 4, 9])]) for _ in range(rng.choice([0, 1, 5, 6, 7, 8, 30, 90]))]
    for _ in range(rng.randrange(3)):
        if w:
            a, p = rng.randrange(len(w)), rng.randrange(1, 12)
            for i in range(a + p, min(len(w), a + p * rng.randrange(2, 9))):
                w[i] = w[i - p]
    return rng.choice([" ", "\n", " \t ", "\x0b"]).join(w) + rng.choice(["", " ", "\n"])


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, runs string, n_words int")
    return [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()]


def test_random_texts(spark):
    rng = random.Random(3)
    rows = [(i, random_text(rng)) for i in range(1500)]
    for (i, text), got in zip(rows, sorted(found(spark, rows))):
        w = WORD.findall(text)
        want = brute(w)
        assert got == (i, len(w), want, left(w, want)), text


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a " * 6), (4, "b b b b b"), (4, "b b b b b"), (5, "x y x y x y x y"), (6, "x y x y x y x")]
    got = {(r[0], tuple(r[2]), r[3]) for r in found(spark, rows)}
    assert got == {
        (1, (), ""), (2, (), ""), (3, (), ""), (None, ((0, 6, 1),), "a"), (4, (), "b b b b b"),
        (5, ((0, 8, 2),), "x y"), (6, (), "x y x y x y x"),
    }
    assert found(spark, []) == []


def test_long_texts_take_few_steps(spark):
    unit = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, "a " * 400_000), (2, " ".join([unit] * 5)), (3, " ".join(["x y z " * 50 + "stop"] * 500))]
    got = {r[0]: r[2] for r in found(spark, rows)}
    assert got[1] == [(0, 400_000, 1)] and got[2] == [(0, 100_000, 20_000)]
    assert got[3][0] == (0, 150, 3) and (0, 75_500, 151) in got[3] and len(got[3]) == 501


def test_rare_words_split_again_and_again():
    ids = {c: i for i, c in enumerate("abcdefgh")}
    text = "aaabaaabaaac" + "dddddd" + "e" + "bab"
    h = np.array([ids[c] + 1 for c in text], np.uint64)
    pos, seg = periodic.surviving(h, np.zeros(len(h), np.int64))
    assert "".join(text[p] for p in pos) == "dddddd" and len(set(seg.tolist())) == 1


def test_planted_repeats_follow_the_rule(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37))) for i in range(400)] + [(None, "a b"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = []
    for i, text in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        w = (text or "").split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w[j] if j < a else w[a + (j - a) % p] for j in range(n))
        want.append((i, text))
    assert sorted(map(tuple, periodic.with_repeats(docs).collect()), key=repr) == sorted(want, key=repr)
    assert sum(a != b for a, b in zip(rows, want)) > 20
