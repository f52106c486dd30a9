"""Decontamination against brute force."""

import random
import re

from muster.llm.contained import contained, decontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    held = {}
    for i, text in items:
        w = split(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else ():
            held.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in held}:
            for k in range(len(w) - n + 1):
                ids = held.get(tuple(w[k : k + n]))
                if ids:
                    hit |= set(range(k, k + n))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, words int"),
            spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, key string"))


def test_small_vocabulary_with_overlaps_and_short_items(spark):
    rng = random.Random(3)
    said = lambda n: " ".join(rng.choice("ab Cd é 7 x-y".split()) for _ in range(n))
    items = [(i, said(rng.choice([0, 1, 2, 3, 5, 9, 10, 14, 30]))) for i in range(25)]
    docs = [(d, said(rng.choice([0, 3, 12, 60]))) for d in range(60)] + [(99, items[-1][1] + " " + said(5))]
    assert result(decontaminated(*frames(spark, docs, items))) == brute(docs, items)


def test_defined_cases(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    long = " ".join(f"w{i}" for i in range(40_000))
    docs = [(1, None), (2, ""), (3, "..."), (4, passage), (4, passage), (None, passage.upper()), (5, long + " " + passage), (6, long)]
    items = [(1, passage), (2, passage), (2, passage), (3, None), (4, ""), (5, "p3 p4"), (6, "w39998, w39999")]
    assert result(decontaminated(*frames(spark, docs, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, [], [])
    assert decontaminated(docs, items).collect() == []
    docs, _ = frames(spark, [(1, "one two")], [])
    assert result(decontaminated(docs, items)) == [(1, 2, 0, 0, [])]


def test_smaller_share_finds_changed_windows(spark):
    item = [f"i{k}" for k in range(10)]
    changed = [*item[:9], "other"]
    docs, items = frames(spark, [(1, " ".join(["a", *changed, "b"])), (2, "a b c")], [(7, " ".join(item))])
    _, found = contained(docs, items, share=0.8)
    assert {r.doc_id for r in found.collect()} == {1}
    assert contained(docs, items)[1].count() == 0
