"""Line removal against brute force, and what is left of repeated passages."""

import random
import re

from muster.llm.lines import MARKS, STOPS, WORDS, lines, without_repeats
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
TOKEN = re.compile(f"[^{WHITE}{STOPS}]+|[{STOPS}]+|[{WHITE}]+")


def cut(text):
    """The lines, token by token: words, stops and white space in turn."""
    tokens, out, n, cur = TOKEN.findall(text), [], 0, ""
    for i, x in enumerate(tokens):
        cur += x
        if x[0] in WHITE:
            if i and not cur.isspace() and tokens[i - 1][0] not in STOPS and n < WORDS and tokens[i - 1][-1] not in MARKS and "\n" not in x and i + 1 < len(tokens):
                continue
        elif i + 1 < len(tokens) and (x[0] in STOPS) <= (tokens[i + 1][0] in STOPS + WHITE):
            n += 1
            continue
        out.append(cur)
        n, cur = 0, ""
    return out


def brute(rows):
    """Rows must differ in (doc_id, text) and in doc_id."""
    seen, out = set(), []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        if text is None:
            out.append((d, None, 0, 0))
            continue
        found = cut(text)
        bare = [x.strip(WHITE) for x in found]
        gone = set()
        for i in range(len(found) - 2):
            k = tuple(bare[i : i + 3])
            if k in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(k)
        out.append((d, "".join(x for i, x in enumerate(found) if i not in gone), len(found), len(gone)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in df.collect()), key=repr)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(without_repeats(docs)) == brute(rows)


def test_overlaps_and_separators(spark):
    rng = random.Random(8)
    bits = [f"line number {k} with some more words." for k in range(6)] + ["", "x", "odd\ue000mark, in a longer line", "一句话。又一句，", "no mark " * 9]
    rows = [(d, "".join(rng.choice(bits) + rng.choice(["\n", " ", "\n\n", "\r\n\t"]) for _ in range(rng.randint(0, 25)))) for d in range(60)]
    docs = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, text string, place int, _d string")
    assert result(without_repeats(docs)) == brute(rows)


def test_passage_on_one_line_goes_where_it_recurs(spark):
    passage = " ".join(f"Sentence number {k} has its own words here." for k in range(8))
    rows = [(1, "Before it all. " + passage + " After that.\nEnd"), (2, "Other words stand here.\n" + passage + "\nTail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in without_repeats(docs).collect()}
    assert got[1] == rows[0][1] and got[2] == "Other words stand here.\nTail"


def test_defined_cases(spark):
    long = "\n".join(f"own line {k} of the long text" for k in range(20_000))
    rows = [(None, "a longer first line here\n" * 3), (1, None), (2, ""), (3, "a longer first line here\n" * 3), (4, long), (5, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(without_repeats(docs)) == brute(rows)
    twice = spark.createDataFrame([(7, "one longer line of text\n" * 2 + "end of it"), (7, "one longer line of text\n" * 2 + "end of it")], "doc_id long, text string")
    assert [r.n_removed for r in without_repeats(twice).collect()] == [0, 0]
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lines_put_together_are_the_text(spark):
    """Random texts over all code points, white space, marks and stops, and one without any white space."""
    rng = random.Random(9)
    some = lambda: chr((lambda c: c + 0x800 * (c >= 0xD800))(rng.randrange(0x10F800)))
    rows = ["".join(rng.choice([some(), rng.choice("ab."), rng.choice(WHITE + MARKS + STOPS), " "]) for _ in range(rng.randrange(120))) for _ in range(400)]
    rows += ["keep \ue000 this\n...\nlast\ue000\nline", "x" * 300_000, "。" * 1000, " " * 50_000, ("a" + " " * 2000 + "\n") * 20]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string").select("doc_id", lines(F.col("text")).alias("l"))
    for i, found in docs.collect():
        assert found == cut(rows[i]) and "".join(found) == rows[i]


def test_short_lines_that_recur_go(spark):
    docs = spark.createDataFrame([(i, "one\ntwo\nthree") for i in range(3)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in without_repeats(docs).collect()) == [(0, "one\ntwo\nthree"), (1, ""), (2, "")]


def test_no_passage_of_fifty_words_stays(spark):
    """Passages that begin and end inside sentences, with marks of many kinds and long sentences."""
    rng = random.Random(10)

    def prose(n):
        out = []
        while len(out) < n:
            out += [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 16))]
            out[-1] += rng.choice([".", "!", "?", ";", ",", ":"])
        return out[:n]

    passages = [prose(rng.randrange(55, 90)) for _ in range(60)]
    rows = [(i, " ".join([*prose(rng.randrange(3, 40)), *passages[i % 60], *prose(rng.randrange(3, 40))])) for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, left = set(), 0
    for r in sorted(without_repeats(docs).collect()):
        w = r.text.split()
        own = {tuple(w[k : k + 51]) for k in range(len(w) - 50)}
        left += bool(own & seen)
        seen |= own
    assert left <= 2
