"""The divergence audit against plain counting, with random groups, odd cases and exact arithmetic."""

import random
import re
from collections import Counter, defaultdict

from muster.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 10**9


def brute(rows, least_docs=3, top=200):
    said, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(text or "")]
        said[lang or "", source or ""].update(w)
        docs[lang or ""].update(set(w))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        groups = {s: c for (x, s), c in said.items() if x == lang}
        shares = lambda c: {t: 1 + SCALE * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1)]
    return sorted(out)


def audit(spark, rows, **kw):
    docs = spark.createDataFrame([(7, *r, 0, "x") for r in rows], "doc_id long, lang string, source string, text string, n int, p string")
    return sorted(map(tuple, divergence.divergences(docs, **kw).collect()))


def test_random_groups(spark):
    rng = random.Random(4)
    vocabulary = [rng.choice("abcdéßжZ") * rng.randrange(1, 4) + rng.choice("xyzÄ") for _ in range(150)]
    rows = []
    for _ in range(500):
        some = rng.sample(vocabulary, rng.randrange(1, 60))
        text = rng.choice([" ", "1", "-"]).join(rng.choices(some, k=rng.randrange(1, 80)))
        rows.append((rng.choice(["en", "de", "de", None]), f"s{rng.randrange(5)}", text))
    assert audit(spark, rows) == brute(rows)
    assert audit(spark, rows, least_docs=5, top=3) == brute(rows, 5, 3)


def test_defined_cases(spark):
    rows = [("en", "a", "the the cat"), ("en", "a", "the cat"), ("en", "b", "The dog"), ("en", "c", None), ("en", None, ""), (None, None, "x"), (None, "q", "x X x"),
            ("fr", "a", "un deux"), ("fr", "b", "1 2 3"), ("de", "a", "q " * 50_000), ("de", "b", "q"), ("de", "a", "q r")]
    got = audit(spark, rows)
    assert got == brute(rows)
    assert [r for r in got if r[0] == "fr"] == [("fr", "a", "pair", "b", 0, 1), ("fr", "b", "pair", "a", 0, 1)]
    assert audit(spark, []) == []


def test_terms_that_polynomial_hashes_take_for_one(spark):
    """Thue-Morse words of 1,024 letters agree in every polynomial hash modulo 2^64."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [("en", s, f"{one} {other} {other}" + " q" * k) for k, s in enumerate("aabbab")]
    got = audit(spark, rows)
    assert got == brute(rows)
    assert {r[3] for r in audit(spark, [*rows, ("en", "c", "q")]) if r[2] == "term"} >= {one, other}


def test_counts_beyond_a_long(spark):
    """Numerators are decimals: 10^9 times a count of 10^13 is exact."""
    rows = spark.createDataFrame([(10**13, 3 * 10**13 + 7, 12), (0, 5, 0)], "n long, total long, kept long")
    got = [r[0] for r in rows.select(divergence.share("n", "total", "kept")).collect()]
    assert got == [1 + SCALE * (10**13 + 1) // (3 * 10**13 + 19), 1 + SCALE // 5]


def test_tables_are_handed_on_before_they_grow(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    held, rng = divergence._Counts(), random.Random(6)
    import numpy as np
    import pyarrow as pa
    from muster.llm import texts

    want = Counter()
    held.groups = {("en", "a"): 0, ("en", "b"): 1}
    for _ in range(30):
        column = [" ".join(rng.choices(["one", "two", "three", "vier"], k=9)) for _ in range(4)]
        for k, x in enumerate(column):
            want.update(("ab"[k % 2], w) for w in x.split())
        for t in texts.slices(pa.array(column)):
            held.add(t, np.array([0, 1, 0, 1]))
        assert held.size <= 50
    out = held.taken()
    assert {(s, w): n for s, w, n in zip(*(out.column(c).to_pylist() for c in ("source", "term", "n")))} == want
