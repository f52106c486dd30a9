"""Weak-label quality model: labellers' accuracies by expectation-maximisation, and a hashed linear scorer on their posterior.

Two faults are modelled alike: "junk" and "toxic". Each has overlapping labellers that vote yes, no or nothing on a document: rules on
its measurements; counts of its words and their beginnings in lists mined from labelled rows; and the label itself where there is one. A sign votes yes or nothing, since faulty documents differ in their
signs; one more labeller votes no where no sign comes near. Every document votes. Documents with equal votes are
counted together (at most 3^labellers patterns), and expectation-maximisation on those counts estimates the share of faulty
documents and each labeller's chance of each vote given the truth. A pattern's posterior is the weak label of its
documents.

A linear scorer over hashed words and word beginnings is trained on the posterior by full-batch gradients that Spark sums per
step. A document's fault probability is the mean of posterior and score, and it is kept if neither fault reaches 1/2.

Bounds, as parameters: mining uses at most about `labelled` labelled rows, the scorer's fit about `fitted` documents, both chosen by a
hash of doc_id; mined lists have at most `listed` entries each. Votes, pattern counts, accuracies and scores cover all documents.

Defined cases: null, empty and wordless texts have only "no" votes or none, and are kept. Repeated rows count and score as often as they
stand there. Several labels for one doc_id: the highest counts. Null doc_ids have no label and are scored as any. No labels at
all: mined lists are empty and their labellers, no_sign among them, silent. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm import near, rules, texts
from muster.llm.common import staged, text_key

FAULTS = {"junk": ["symbols", "capitals", "repeats", "bars", "plain", "label"], "toxic": ["mined_words", "mined_beginnings", "no_sign", "label"]}
LABELLED, FITTED, LISTED = 20_000, 20_000, 2_000
WIDTH = 1 << 14
BEGINNING = 5
STEPS, RATE, DECAY = 20, 0.8, 1e-4
YES, NO, NONE = 1, 0, 2
#: Documents of each vote (no, yes, nothing) added to the sound and to the faulty side.
_BELIEF = [(4.0, 0.1, 4.0), (0.5, 4.0, 1.0)]


@dataclass
class Features:
    """A slice's lower-cased words: their hashes, their beginnings' hashes, and each text's range of them."""

    word: np.ndarray
    beginning: np.ndarray
    by: np.ndarray


def features(t: texts.Texts) -> Features:
    low = texts.Texts(texts.LOWER[t.data], t.off, t.first)
    w = texts.words(low, texts.ALNUM)
    sums = texts.prefix(low.data)
    return Features(texts.ranges(sums, w.start, w.end), texts.ranges(sums, w.start, np.minimum(w.end, w.start + BEGINNING)), w.by)


def _share(docs: DataFrame, bound: int, total: int):
    """About `bound` of `total` rows, chosen by a hash of doc_id."""
    limit = min(1.0, bound / max(1, total))
    return F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < F.lit(int(limit * 1_000_000))


def classes(sigs: np.ndarray) -> np.ndarray:
    """A class number for each MinHash signature (rows of symbols): near copies share it.

    Rows that agree in a chunk of symbols are compared with the first of them; the work is linear in the rows.
    """
    up = np.arange(len(sigs))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for k in range(0, sigs.shape[1], near.CHUNK):
        _, first, which = np.unique(sigs[:, k : k + near.CHUNK], axis=0, return_index=True, return_inverse=True)
        lead = first[which.reshape(-1)]
        same = (lead != np.arange(len(sigs))) & ((sigs != sigs[lead]).sum(axis=1) <= near.DISTANCE)
        for i in np.flatnonzero(same).tolist():
            a, b = root(i), root(int(lead[i]))
            up[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(sigs))], np.int64)


def mined(docs: DataFrame, labels: DataFrame, labelled: int, listed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of word beginnings that stand nearly only in toxic labelled texts.

    Both sides are counted in distinct texts, near copies being one, and compared as shares of their side.
    """
    spark = docs.sparkSession
    sample = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    sample = sample.where(_share(sample, labelled, sample.count()))  # so few rows that Spark may broadcast them by their size
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), text.alias("text")).join(sample, "doc_id")
    rows = staged(rows.select((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("int").alias("doc_id"), "key", "text"), "labelled")  # the label, where sketches pass it on
    told = near.sketches(rows, 5).where("sig IS NOT NULL").groupBy("doc_id", "key").agg(F.first("sig").alias("sig")).collect()
    bad_text = np.array([r[0] == 1 for r in told], bool)
    key = np.array([r[1] for r in told], np.int64)
    of = classes(np.frombuffer(b"".join(r[2] for r in told), np.uint16).reshape(-1, near.SYMBOLS))
    n_bad, n_sound = (len(np.unique(of[side])) for side in (bad_text, ~bad_text))
    shared = np.bincount(of, minlength=1)[of] > 1  # a text alone in its class needs no class number
    name, where = np.unique(key[shared], return_index=True)
    held = spark.sparkContext.broadcast((name, of[shared][where]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, number = held.value
        for b in batches:
            bad = b.column(0).to_numpy() == 1
            key = b.column(1).to_numpy()
            at = np.searchsorted(name, key)
            known = np.append(name, 0)[at] == key
            known &= at < len(name)
            cls = np.where(known, np.append(number, -1)[at], -1)
            for t in texts.slices(b.column(2)):
                f = features(t)
                who = np.repeat(np.arange(len(t)), np.diff(f.by))
                for kind, h in enumerate((f.word, f.beginning)):
                    _, first = np.unique(h ^ texts.mix(who.astype(np.uint64)), return_index=True)  # once a text
                    side, group = bad[t.first + who[first]], cls[t.first + who[first]]
                    order = np.lexsort((group, side, h[first]))
                    x = h[first][order], side[order], group[order]
                    new = np.ones(len(order), bool)
                    new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in x])
                    start = np.flatnonzero(new)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), kind, np.int32)), pa.array(texts.int64(x[0][start])), pa.array(x[1][start]),
                         pa.array(x[2][start]), pa.array(np.diff(np.append(start, len(order))))],
                        names=["kind", "h", "toxic", "class", "n"],
                    )

    spots = rows.mapInArrow(run, "kind int, h long, toxic boolean, class long, n long").groupBy("kind", "h", "toxic", "class").agg(F.sum("n").alias("n"))
    once = F.when(F.col("class") < 0, F.col("n")).otherwise(1)
    counted = spots.groupBy("kind", "h").agg(*[F.coalesce(F.sum(F.when(F.col("toxic") == side, once)), F.lit(0)).alias(c) for c, side in (("bad", True), ("sound", False))])
    rare = F.col("sound") * F.lit(float(n_bad)) <= 0.05 * F.col("bad") * F.lit(float(n_sound))
    telling = staged(counted.where((F.col("bad") >= 8) & rare), "mined")
    out = []
    for kind in (0, 1):  # at most `listed` rows each
        top = telling.where(F.col("kind") == kind).orderBy(F.desc("bad"), "h").limit(listed).select("h").collect()
        out.append(np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64)))
    return out[0], out[1]


def _within(sorted_list: np.ndarray, h: np.ndarray, by: np.ndarray) -> np.ndarray:
    if not len(sorted_list):
        return np.zeros(len(by) - 1, np.int64)
    k = np.minimum(np.searchsorted(sorted_list, h), len(sorted_list) - 1)
    return texts.totals(sorted_list[k] == h, by)


def _vote(yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    return np.where(yes, YES, np.where(no, NO, NONE))


_BAR = np.arange(256) == ord("|")


def votes(t: texts.Texts, f: Features, lists: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """Each labeller's vote on every text of a slice, but for the labels themselves."""
    m = rules.measure(t)
    n, some = np.maximum(1, m["n_words"]), m["n_words"] > 0
    bars = texts.totals(_BAR[t.data], t.off)
    other = m["n_symbols"] - bars
    count = [_within(*x, f.by) for x in ((lists[0], f.word), (lists[1], f.beginning))]
    never = np.zeros(len(t), bool)
    signs = {
        "symbols": (other > 0.5 * n, other < 0.05 * n),
        "bars": (bars > 0.3 * n, bars < 0.1 * n),
        "capitals": ((m["n_upper"] > 0.4 * m["n_letters"]) & (n >= 8), m["n_upper"] < 0.25 * m["n_letters"]),
        "repeats": ((m["n_repeat_words"] > 0.3 * n) & (n >= 80), m["n_repeat_words"] < 0.3 * n),
    }
    found = {name: _vote(some & yes, never) for name, (yes, _) in signs.items()}
    found["plain"] = _vote(never, ~some | np.logical_and.reduce([no for _, no in signs.values()]))
    found |= {name: _vote(c >= least, never) for name, c, least in zip(("mined_words", "mined_beginnings"), count, (1, 2))}
    found["no_sign"] = _vote(never, (sum(count) == 0) & bool(sum(map(len, lists))))  # no lists, no sign to miss
    return found


def _buckets(f: Features) -> np.ndarray:
    """Feature numbers of every word: two for each."""
    half = np.uint64(WIDTH // 2)
    return np.stack([f.word % half, f.beginning % half + half], axis=1).astype(np.int64)


def voted(docs: DataFrame, labels: DataFrame, lists: tuple[np.ndarray, np.ndarray], fitted: int, total: int) -> DataFrame:
    """(doc_id, key, votes..., marks): one row per document; marks holds the distinct features of documents in the fit."""
    names = [v for fault in FAULTS.values() for v in fault if v != "label"]
    held = docs.sparkSession.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit = b.column(3).to_numpy(zero_copy_only=False)
            for t in texts.slices(b.column(2)):
                f = features(t)
                found = votes(t, f, held.value)
                two = _buckets(f)
                marks = [np.unique(two[f.by[i] : f.by[i + 1]]).astype("<u2").tobytes() if fit[t.first + i] else None for i in range(len(t))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(t.first, len(t)), b.column(1).slice(t.first, len(t)), *(pa.array(found[v].astype(np.int32)) for v in names), pa.array(marks, pa.binary())],
                    names=["doc_id", "key", *names, "marks"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"),
        F.coalesce(_share(docs, fitted, total), F.lit(False)).alias("fit"),
    )
    out = staged(rows.mapInArrow(run, "doc_id long, key long, " + ", ".join(f"{v} int" for v in names) + ", marks binary"), "votes")
    said = labels.groupBy(F.col("doc_id").cast("long").alias("_d")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("_d IS NOT NULL")
    told = lambda c, yes: F.when(F.col(c).isNull(), NONE).when(F.col(c) == yes, YES).otherwise(NO)
    return out.join(said, F.col("doc_id") == F.col("_d"), "left").select(
        *out.columns, told("quality", 0).alias("junk_label"), told("toxic", 1).alias("toxic_label")
    )


def _columns(fault: str) -> list[str]:
    return [f"{fault}_label" if v == "label" else v for v in FAULTS[fault]]


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of faulty documents, each labeller's vote chances given the truth, and each pattern's posterior.

    Starts from the balance of votes. A few documents' worth of belief that labellers beat chance (_BELIEF), and that fewer than half
    of all documents are faulty, fixes which side is which; in a large table they weigh next to nothing.
    """
    yes, no = (patterns == YES).sum(axis=1), (patterns == NO).sum(axis=1)
    post = np.where(yes > 0, 0.5 + 0.45 * (yes / np.maximum(1, yes + no)), 0.02)
    prior, chance = 0.5, np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        for side, weight in enumerate((counts * (1 - post), counts * post)):
            for v in (YES, NO, NONE):
                chance[side, :, v] = ((patterns == v) * weight[:, None]).sum(axis=0) + _BELIEF[side][v]
            chance[side] /= chance[side].sum(axis=1, keepdims=True)
        prior = float(np.clip(((counts * post).sum() + 1) / (counts.sum() + 10), 1e-4, 0.5))
        # what a labeller's silence is worth is left out: it tells of its coverage, not of the document
        log = np.log(chance)
        log[:, :, NONE] = 0
        each = [sum(log[s, j, patterns[:, j]] for j in range(patterns.shape[1])) for s in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(each[0] + np.log(1 - prior) - each[1] - np.log(prior), -500, 500)))
        if len(new) == 0 or np.abs(new - post).max() < 1e-9:
            break
        post = new
    return prior, chance, post


def posteriors(rows: DataFrame, fault: str) -> tuple[dict[tuple[int, ...], float], dict]:
    """Posterior by vote pattern, and what was estimated. At most 3^labellers rows reach the driver."""
    cols = _columns(fault)
    got = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([[r[c] for c in cols] for r in got], np.int64).reshape(-1, len(cols))
    prior, chance, post = accuracies(patterns, np.array([r["n"] for r in got], float))
    found = {"share": prior, **{c: {"yes_if_faulty": chance[1, j, YES], "no_if_sound": chance[0, j, NO]} for j, c in enumerate(cols)}}
    return {tuple(p): float(q) for p, q in zip(patterns.tolist(), post)}, found


def fit(rows: DataFrame) -> np.ndarray:
    """Weights (WIDTH + 1 for the bias, faults) of the scorer, from rows (marks, one posterior per fault).

    Each step sums the gradient over all tasks; a step's result has as many rows as there are features.
    """
    spark, n_faults = rows.sparkSession, len(FAULTS)
    total = rows.count()
    weights, seen = np.zeros((WIDTH + 1, n_faults)), np.full((WIDTH + 1, n_faults), 1e-8)
    if not total:
        return weights
    for _ in range(STEPS):
        held = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grad = np.zeros((WIDTH + 1, n_faults))
            for b in batches:
                truth = np.stack([b.column(1 + k).to_numpy() for k in range(n_faults)], axis=1)
                for i, m in enumerate(b.column(0)):
                    idx = np.append(np.frombuffer(m.as_buffer(), "<u2"), WIDTH)
                    scale = 1 / np.sqrt(len(idx))
                    p = 1 / (1 + np.exp(-np.clip(held.value[idx].sum(axis=0) * scale, -30, 30)))
                    grad[idx] += (p - truth[i]) * scale
            yield pa.RecordBatch.from_arrays([pa.array([grad.tobytes()], pa.binary())], names=["g"])

        grad = np.zeros_like(weights)
        for (g,) in rows.mapInArrow(run, "g binary").collect():
            grad += np.frombuffer(g).reshape(grad.shape)
        grad = grad / total + DECAY * weights
        seen += grad * grad
        weights = weights - RATE * grad / np.sqrt(seen)
        held.unpersist()
    return weights


def scored(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, fitted: int = FITTED, listed: int = LISTED) -> DataFrame:
    """(doc_id, key, p_junk, p_toxic, score_junk, score_toxic, kept) per row of `docs`; p is the posterior."""
    spark = docs.sparkSession
    total = docs.count()
    lists = mined(docs, labels, labelled, listed)
    rows = staged(voted(docs, labels, lists, fitted, total), "voted")
    posterior = {}
    for fault in FAULTS:
        known, _ = posteriors(rows, fault)
        pairs = [F.struct(F.lit(",".join(map(str, p))).alias("key"), F.lit(q).alias("value")) for p, q in known.items()]
        table = F.map_from_entries(F.array(*pairs)) if pairs else F.create_map().cast("map<string,double>")
        posterior[fault] = table[F.concat_ws(",", *[F.col(c).cast("string") for c in _columns(fault)])]
    rows = rows.select("doc_id", "key", "marks", *[posterior[f].alias(f"p_{f}") for f in FAULTS])
    light = staged(rows, "posteriors")
    train = light.where("marks IS NOT NULL").select("marks", *[f"p_{f}" for f in FAULTS]).repartition(8).persist()
    held = spark.sparkContext.broadcast(fit(train))
    train.unpersist()
    names = [f"score_{f}" for f in FAULTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = held.value
        for b in batches:
            for t in texts.slices(b.column(2)):
                f = features(t)
                two = _buckets(f)
                out = np.zeros((len(t), len(FAULTS)))
                for i in range(len(t)):
                    idx = np.append(np.unique(two[f.by[i] : f.by[i + 1]]), WIDTH)
                    out[i] = 1 / (1 + np.exp(-np.clip(weights[idx].sum(axis=0) / np.sqrt(len(idx)), -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), b.column(1).slice(t.first, len(t)), *(pa.array(out[:, k]) for k in range(len(FAULTS)))], names=["doc_id", "key", *names])

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text").cast("string").alias("text"))
    scores = each.mapInArrow(run, "doc_id long, key long, " + ", ".join(f"{n} double" for n in names))
    weak = light.groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(*[F.first(f"p_{f}").alias(f"p_{f}") for f in FAULTS])
    both = scores.join(weak, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    sound = [F.col(f"p_{f}") + F.col(f"score_{f}") < 1 for f in FAULTS]
    return both.select("doc_id", "key", *[f"p_{f}" for f in FAULTS], *names, (sound[0] & sound[1]).alias("kept"))
