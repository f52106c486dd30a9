"""Secret scan: the patterns' spans against Python's, and the character models on planted strings."""

import random
import re
import string

from muster.llm import secret_scan as S
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z in sorted(out))


def scanned(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, base string")
    return S.scanned(docs).select("doc_id", S.listed(F.col("base")).alias("base"), "added")


def test_pattern_spans_of_documents_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = random.Random(5)
    bits = ["token", "Secret", "API_KEY", "passwd", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJ0123456789", "abcdef0123", "xyz-", "é", "\x01", "\x02", "\x03", "😀", "\n", "KEY", "-=", "$1", "\\"]
    odd = [(10**6 + k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(1500)]
    rows = [tuple(r) for r in docs.collect()] + odd
    got = {r.doc_id: r.base for r in scanned(spark, rows).collect()}
    assert got == {d: base(t) for d, t in rows}


def test_models_add_random_strings_and_no_words(spark):
    rng = random.Random(6)
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    planted = {}
    for k in range(40):
        secret = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(32))
        planted[10**6 + k] = (len("some plain words then "), secret)
        docs.append((10**6 + k, f"some plain words then {secret} and more"))
    found = {r.doc_id: r.added for r in scanned(spark, docs).collect()}
    hit = sum(any(s.start == at and s.value == secret for s in found[d]) for d, (at, secret) in planted.items())
    assert hit >= 38
    assert sum(len(v) for d, v in found.items() if d not in planted) <= 2


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "token=abcdefghijkl"), (3, "a " * 50_000 + "AKIA" + "Z" * 20), (3, "x"), (3, "x")]
    got = sorted(((r.doc_id, r.base, len(r.added)) for r in scanned(spark, rows).collect()), key=repr)
    assert got == sorted(((d, base(t), 0) for d, t in rows), key=repr)


def test_empty_table(spark):
    assert scanned(spark, []).collect() == []


def test_very_many_matches_in_one_text(spark):
    rng = random.Random(7)
    words = ["%016x" % rng.getrandbits(64) if k % 2 else "token=" + "%012d" % k if k % 10 == 0 else "word" * 5 for k in range(20_000)]
    text = " ".join(words)
    got = scanned(spark, [(1, text)]).collect()[0]
    assert got.base == base(text)


def test_spans_next_to_and_over_others(spark):
    rng = random.Random(8)
    bits = ["abcdef0123456789", "ABCDEFGHIJKLMNOPQ", "token=", "AKIA", "ABCDEF0123456789", " ", "-", "/", "."]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.scanned(docs, least=-1e9).collect()}
    for d, text in rows:
        named = [(s.start, s.end) for s in got[d].base]
        runs = [(m.start(), m.end()) for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text)]
        assert [(s.start, s.end) for s in got[d].added] == [(a, z) for a, z in runs if not any(b < z and a < y for b, y in named)]


def test_copies_change_no_ratio(spark):
    rng = random.Random(9)
    texts = [f"words like ordinary_names and other_identifiers {''.join(rng.choice(string.hexdigits.lower()) for _ in range(20))}" for _ in range(60)]
    one = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    many = one.union(spark.createDataFrame([(1000 + k, texts[0]) for k in range(300)], "doc_id long, text string"))
    secret = spark.createDataFrame([(5000, "k7Qz9XvB2mLp4RtW8sYd")], "doc_id long, text string")
    few = S.scanned(one.union(secret), sample=10**6).where("doc_id = 5000").collect()[0].added
    assert S.scanned(many.union(secret), sample=10**6).where("doc_id = 5000").collect()[0].added == few
