"""Hidden Markov language model: Baum-Welch counts summed across tasks, and exact sequence likelihoods.

Tokens are lower-cased words and one end per text. Word counts come from all training documents, without bound: per block of
documents a dictionary, and two joins on the word. The hidden states emit one of `WIDTH` classes of words (a hash of the word) or
the end, so transition and emission tables have a fixed size; a word's probability is its class's from the model, times its
own in the class from the counts. That sums to one over words, with one place in each class for unknown words.

Training: every round, each task runs scaled forward and backward recursions over its training texts, cut into runs of at most `RUN`
tokens, and adds up expected counts; Spark sums those tables over tasks. Scoring: a text's likelihood is exact however long it is:
each run's product of transition matrices is computed, scaled, side by side with the others, then multiplied along the text.

Defined cases: null and empty texts are one end token. A null doc_id is in training. Repeated rows count and score each. Without any
training text every word is unknown. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm import texts
from muster.llm.common import staged

STATES, WIDTH, RUN, ROUNDS = 4, 4096, 64, 3
BLOCK_WORDS = 800_000
ADD = 0.1
#: The end token's name among word hashes.
END = np.uint64(0x454E44)
_BLOCK = "block long, doc_id array<long>, held_out array<boolean>, n_tokens array<int>, codes binary, words array<long>, times array<int>"


def classes(words: np.ndarray) -> np.ndarray:
    return np.where(words == END, WIDTH, (words >> np.uint64(40)) % np.uint64(WIDTH)).astype(np.int64)


def squeezed(codes: np.ndarray) -> bytes:
    """Token codes byte plane by byte plane, compressed: small codes are the frequent ones, so high planes are nearly empty."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def expanded(blob: pa.Scalar, n: int) -> np.ndarray:
    raw = pa.decompress(blob.as_buffer(), decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def blocks(docs: DataFrame) -> DataFrame:
    """Documents in blocks of about BLOCK_WORDS tokens: a row has their ids, lengths and tokens, coded by the block's own
    dictionary, and the dictionary with its training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        held: list[bool] = []
        tokens: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            n = np.concatenate(sizes)
            words, codes, found = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            order = np.argsort(-found, kind="stable")
            words, codes = words[order], np.argsort(order, kind="stable")[codes]
            times = np.bincount(codes, np.repeat(~np.array(held), n), len(words)).astype(np.int32)
            one = lambda x, kind: pa.array([x], kind)
            return pa.RecordBatch.from_arrays(
                [one(number, pa.int64()), one(ids, pa.list_(pa.int64())), one(held, pa.list_(pa.bool_())), one(n.astype(np.int32), pa.list_(pa.int32())),
                 one(squeezed(codes), pa.binary()), one(texts.int64(words), pa.list_(pa.int64())), one(times, pa.list_(pa.int32()))],
                names=["block", "doc_id", "held_out", "n_tokens", "codes", "words", "times"],
            )

        for b in batches:
            for t in texts.slices(b.column(2)):
                t.data = texts.LOWER[t.data]
                w = texts.words(t, texts.SPACED)
                h = texts.ranges(texts.prefix(t.data), w.start, w.end)
                tokens.append(np.insert(h, w.by[1:], END))
                sizes.append(np.diff(w.by) + 1)
                ids += b.column(0).slice(t.first, len(t)).to_pylist()
                held += b.column(1).slice(t.first, len(t)).to_pylist()
                size += len(h) + len(t)
                if size >= BLOCK_WORDS:
                    yield row()
                    number, size = number + 1, 0
                    for x in (ids, held, tokens, sizes):
                        x.clear()
        if ids:
            yield row()

    doc = F.col("doc_id").cast("long")
    held_out = F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    rows = docs.select(doc.alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _BLOCK)


@dataclass
class Runs:
    """Texts cut into runs of at most RUN tokens, longest first. `at` is a run's first token; `text` and `nth` say whose."""

    at: np.ndarray
    n: np.ndarray
    text: np.ndarray
    nth: np.ndarray

    def active(self) -> np.ndarray:
        """How many runs have a token t, for t from 0 on."""
        return np.searchsorted(-self.n, -np.arange(RUN), "left")


def cut(n_tokens: np.ndarray, first: np.ndarray) -> Runs:
    pieces = -(-n_tokens // RUN)
    text = np.repeat(np.arange(len(n_tokens)), pieces)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    n = np.minimum(RUN, n_tokens[text] - nth * RUN)
    order = np.argsort(-n, kind="stable")
    return Runs((first[text] + nth * RUN)[order], n[order], text[order], nth[order])


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # states x classes


def initial(shares: np.ndarray, states: int = STATES) -> Model:
    """Emissions near the classes' shares, pushed apart by fixed random factors; states that like to stay."""
    rng = np.random.default_rng(7)
    emit = shares * rng.uniform(0.5, 1.5, (states, len(shares)))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))


def expected(m: Model, seen: np.ndarray, r: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over runs of the class sequence, and their log likelihood."""
    s, n, active = len(m.start), len(r.at), r.active()
    steps = int((active > 0).sum())
    alpha, scale = [], []
    for t in range(steps):
        k = active[t]
        e = m.emit[:, seen[r.at[:k] + t]]
        a = e * (m.start[:, None] if t == 0 else m.move.T @ alpha[-1][:, :k])
        c = a.sum(axis=0)
        alpha.append(a / c)
        scale.append(c)
    starts, moves, emits = np.zeros(s), np.zeros((s, s)), np.zeros((s, m.emit.shape[1]))
    gammas, where = [], []
    beta = np.ones((s, 0))
    for t in range(steps - 1, -1, -1):
        k = active[t]
        full = np.ones((s, k))
        if beta.shape[1]:
            j = beta.shape[1]
            ahead = beta * m.emit[:, seen[r.at[:j] + t + 1]] / scale[t + 1]
            moves += m.move * (alpha[t][:, :j] @ ahead.T)
            full[:, :j] = m.move @ ahead
        g = alpha[t] * full
        gammas.append(g)
        where.append(seen[r.at[:k] + t])
        beta = full
    if steps:
        starts = gammas[-1].sum(axis=1)
        g, x = np.concatenate(gammas, axis=1), np.concatenate(where)
        for i in range(s):
            emits[i] = np.bincount(x, g[i], m.emit.shape[1])
    return starts, moves, emits, float(sum(np.log(c).sum() for c in scale)) if n else 0.0


def likelihoods(m: Model, seen: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
    """log10 probability of each text's class sequence: the scaled forward recursion, exact over any length."""
    s = len(m.start)
    r = cut(n_tokens, np.cumsum(n_tokens) - n_tokens)
    active, n = r.active(), len(r.at)
    product = np.tile(np.eye(s)[:, :, None], (1, 1, n))  # from state, to state, run
    logs = np.zeros(n)
    for t in range(int((active > 0).sum())):
        k = active[t]
        p = product[:, :, :k]
        if t:
            p = np.einsum("ijn,jk->ikn", p, m.move)
        else:  # a text's first token is not moved to
            moved = np.einsum("ijn,jk->ikn", p, m.move)
            p = np.where((r.nth[:k] == 0)[None, None, :], p, moved)
        p = p * m.emit[:, seen[r.at[:k] + t]][None]
        c = p.max(axis=(0, 1))
        product[:, :, :k] = p / c
        logs[:k] += np.log(c)
    out = np.zeros(len(n_tokens))
    state = np.tile(m.start[:, None], (1, len(n_tokens)))
    by_nth = np.argsort(r.nth, kind="stable")
    borders = np.searchsorted(r.nth[by_nth], np.arange(int(r.nth.max()) + 2)) if n else [0]
    for a, z in zip(borders[:-1], borders[1:]):
        k = by_nth[a:z]
        d = r.text[k]
        v = np.einsum("in,ijn->jn", state[:, d], product[:, :, k])
        c = v.sum(axis=0)
        state[:, d] = v / c
        out[d] += np.log(c) + logs[k]
    return out / np.log(10)


def train(rows: DataFrame, shares: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts. A round's sums have one row per table entry."""
    spark, s, width = rows.sparkSession, STATES, len(shares)
    m = initial(shares)
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(m)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(s + s * s + s * width)
            for b in batches:
                for i in range(b.num_rows):
                    out, n, codes, words = (b.column(c)[i] for c in range(4))
                    n = n.values.to_numpy().astype(np.int64)
                    seen = classes(words.values.to_numpy().view(np.uint64))[expanded(codes, int(n.sum()))]
                    mine = ~out.values.to_numpy(zero_copy_only=False)
                    found = expected(held.value, seen, cut(n[mine], (np.cumsum(n) - n)[mine]))
                    total += np.concatenate([x.ravel() for x in found[:3]])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

        sums = np.zeros(s + s * s + s * width)
        added = rows.select("held_out", "n_tokens", "codes", "words").mapInArrow(run, "at long, n double")
        for at, n in added.groupBy("at").agg(F.sum("n")).collect():
            sums[at] = n
        starts, moves, emits = sums[:s] + 1, sums[s : s + s * s].reshape(s, s) + 1, sums[s + s * s :].reshape(s, width)
        emits = emits + shares  # one pseudo-token a state
        m = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=1, keepdims=True))
        held.unpersist()
    return m


def scored(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of `docs`."""
    spark = docs.sparkSession
    rows = staged(blocks(docs), "blocks")
    entries = rows.select("block", F.explode(F.arrays_zip("words", "times")).alias("e")).select("block", F.col("e.words").alias("word"), F.col("e.times").alias("n"))
    totals = staged(entries.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    name = F.when(F.col("word") == int(END), F.lit(WIDTH)).otherwise(F.shiftrightunsigned("word", 40) % WIDTH)
    per = np.zeros((WIDTH + 1, 2))  # tokens and distinct words of each class
    for k, n, v in totals.where("c > 0").groupBy(name.alias("k")).agg(F.sum("c"), F.count(F.lit(1))).collect():
        per[int(k)] = n, v
    n_all, v_all = int(per[:, 0].sum()), int(per[:, 1].sum())
    shares = (per[:, 0] + ADD) / (per[:, 0] + ADD).sum()
    held = spark.sparkContext.broadcast((train(rows, shares, rounds), per))

    def run(key: tuple, own: pa.Table, counts: pa.Table) -> pa.Table:
        model, per = held.value
        words = np.concatenate([x.values.to_numpy() for x in own.column("words")]).view(np.uint64)
        c = np.zeros(len(words))
        order = np.argsort(words)
        c[order[np.searchsorted(words, counts.column("word").to_numpy().view(np.uint64), sorter=order)]] = counts.column("c").to_numpy()
        kinds = classes(words)
        base = np.log10((c + ADD) / (n_all + ADD * (v_all + 1)))
        inner = np.where(kinds == WIDTH, 0.0, np.log10((c + ADD) / (per[kinds, 0] + ADD * (per[kinds, 1] + 1))))
        n = own.column("n_tokens")[0].values.to_numpy().astype(np.int64)
        codes = expanded(own.column("codes")[0], int(n.sum()))
        by = np.concatenate([[0], np.cumsum(n)])
        total = lambda x: np.add.reduceat(x[codes], by[:-1])
        score = total(inner) + likelihoods(model, kinds[codes], n)
        return pa.table({
            "doc_id": own.column("doc_id")[0].values, "held_out": own.column("held_out")[0].values, "n_tokens": pa.array(n),
            "n_known": pa.array(total((c > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(n), n_all)),
            "base_score": pa.array(total(base)), "score": pa.array(score),
        })

    looked_up = entries.select("block", "word").join(totals, "word").select(F.col("block").alias("of"), "word", "c")
    return (
        rows.groupBy("block").cogroup(looked_up.groupBy("of"))
        .applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
