"""The rule ledger: measurements by brute force, policies and ablations."""

import re
from collections import Counter

from muster.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    w = WORD.findall(text)
    three = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if three[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), len(lines),
            sum("A" <= c <= "Z" for c in text), sum("A" <= c <= "Z" or "a" <= c <= "z" for c in text))


def ledger(spark, rows):
    return rules.ledger(spark.createDataFrame([(*r, "en", 0) for r in rows], "doc_id long, text string, n_words string, failed int"))


def test_measurements_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {d: measured(t) for d, t in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r[c] for c in rules.MEASURES) for r in rules.ledger(docs).collect()}
    assert got == want


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a"), (4, "é\né\n\né x"), (4, "é\né\n\né x"), (5, "same line\n" * 30_000), (6, "# " * 60), (7, "A B" * 40)]
    got = sorted(((r.doc_id, *(r[c] for c in rules.MEASURES)) for r in ledger(spark, rows).collect()), key=repr)
    assert got == sorted(((d, *measured(t)) for d, t in rows), key=repr)


def test_policies_and_ablations(spark):
    rows = ledger(spark, [(1, None), (2, "ab " * 60), (3, " ".join(f"w{i}" for i in range(60))), (4, "# " * 10), (5, " ".join(f"W{i}{i}" for i in range(60)))])
    failed = {r.doc_id: r.failed for r in rows.collect()}
    assert failed[3] == 0 and failed[1] & rules.BITS["few_words"] and failed[2] & rules.BITS["repeated_words"]
    found = {(r.version, r.rule): (r.n_rows, r.n_kept, r.n_only) for r in rules.ablations(rows).collect()}
    assert len(found) == sum(bin(m).count("1") for m in rules.POLICIES.values())
    for (version, rule), (n, kept, only) in found.items():
        mask, bit = rules.POLICIES[version], rules.BITS[rule]
        assert (n, kept, only) == (5, sum(not f & mask for f in failed.values()), sum(f & mask == bit for f in failed.values()))


def test_empty_table(spark):
    assert ledger(spark, []).collect() == []
