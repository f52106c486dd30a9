"""Mined words: phrases are found, and copies weigh no more than one text."""

import random

import numpy as np
import pyarrow as pa
from muster.llm import weak
from muster.llm.texts import slices


def hashed(word):
    return weak.features(next(slices(pa.array([word])))).word


def mined(spark, rows):
    """Which of some words are mined from rows (text, toxic)."""
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, x) for k, (_, x) in enumerate(rows)], "doc_id long, quality int, toxic int")
    words, _ = weak.mined(docs, labels, weak.LABELLED, weak.LISTED)
    return lambda word: bool(np.isin(hashed(word), words)[0])


def texts(rng, n, *phrases):
    """Texts of ordinary words, each with the phrases in it."""
    return [" ".join(["".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(60)] + list(phrases)) for _ in range(n)]


def test_phrases_are_mined_and_copies_weigh_once(spark):
    rng = random.Random(9)
    rows = [(t, 1) for t in texts(rng, 60, "you total wretch")]  # always behind the same word
    rows += [(t, 0) for t in texts(rng, 600)]
    wrong = texts(rng, 1, "you total wretch")[0]
    rows += [(wrong, 0)] * 300 + [(f"{wrong} {k}", 0) for k in range(300)]  # one text labelled wrongly, with its copies
    lone = texts(rng, 1, "lonesome quirk")[0]
    rows += [(lone, 1)] * 200 + [(f"{lone} {k}", 1) for k in range(200)]  # one toxic text with copies tells nothing of its words
    found = mined(spark, rows)
    assert found("wretch") and not found("quirk") and not found("abc")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert [len(x) for x in weak.mined(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"), 10, 10)] == [0, 0]


def test_no_word_is_toxic_without_labels(spark):
    said = [(k, text) for k, text in enumerate(texts(random.Random(10), 100) + texts(random.Random(11), 20, "idiot moron scum"))]
    docs = spark.createDataFrame(said, "doc_id long, text string")
    got = weak.scored(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert len({r.p_toxic for r in got.select("p_toxic").collect()}) == 1
