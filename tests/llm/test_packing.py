"""Packing: exact ids, whole coverage, and no more sequences than best-fit decreasing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from muster.llm import texts, tokenizing
from muster.llm.common import vocabulary
from muster.llm.packing import flows, packed
from tokenizers import Tokenizer

VOCABULARY = vocabulary("byte_bpe_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizer_on_odd_texts():
    rng = random.Random(1)
    odd = "  　 \u0085   \x1c \t \n 1 ' s t a é 漢 😀 . ! <|endoftext|>".split(" ") + [" ", "\n", "  "]
    said = [None, "", " ", "  a  b", "don't we'll", *("".join(rng.choice(odd) for _ in range(rng.randint(0, 14))) for _ in range(1500))]
    got = []
    for t in texts.slices(pa.array(said), 500):
        flat, by = tokenizing.encode(t, VOCABULARY)
        got += [flat[by[i] : by[i + 1]].tolist() for i in range(len(t))]
    assert got == [ids(s)[:-1] for s in said]


def test_flows_are_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(100):
        capacity = rng.choice([5, 10, 37, 2048])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([1, 5, 50, 400])))
        plan = flows(counts, capacity)
        keys = plan[:, 0] << 48 | plan[:, 1]
        held = defaultdict(list)
        for length, n in counts.items():
            for rank in range(n):
                k = np.searchsorted(keys, length << 48 | rank, "right") - 1
                held[int(plan[k, 2] + rank - plan[k, 1])].append((int(plan[k, 3]), length))
        for parts in held.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        gaps = []
        for length in sorted(counts.elements(), reverse=True):
            fit = [g for g in gaps if g >= length]
            if fit:
                gaps.remove(min(fit))
            gaps.append((min(fit) if fit else capacity) - length)
        assert len(held) == len(gaps)


def checked(rows, docs, capacity):
    """Every document's ids, piece by piece, and every sequence without gaps or overflow."""
    want = Counter()
    for d, text in docs:
        own = ids(text)
        first = len(own) % capacity or min(capacity, len(own))
        cuts = [0, first, *range(first + capacity, len(own) + 1, capacity)]
        for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, a, z - a, zlib.crc32(np.array(own[a:z], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packs_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    n = checked(packed(docs, VOCABULARY).collect(), rows, 2048)
    assert n <= 1.02 * sum(len(ids(t)) for _, t in rows) / 2048 + 1


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "word " * 700), (4, "x" * 5000), (5, "a b")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, rank int, block int")
    checked(packed(docs, VOCABULARY, capacity=64).collect(), rows, 64)


def test_empty_table(spark):
    assert packed(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).collect() == []
