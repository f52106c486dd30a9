"""Token ids of texts that hold the added token, against the tokenizer as its file loads."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from muster.llm import texts, tokenizing
from muster.llm.common import vocabulary
from muster.llm.packing import packed
from tokenizers import Tokenizer

VOCABULARY = vocabulary("byte_bpe_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_as_loaded():
    rng = random.Random(3)
    odd = ["<|endoftext|>", "<|endoftext|>", "<|endo", "ftext|>", "<", "|>", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "'s", "a", "é", "漢", "😀", "1", "."]
    said = ["<|endo", "ftext|>", None, "", "<|endoftext|>", "a <|endoftext|> b", *("".join(rng.choice(odd) for _ in range(rng.randint(0, 14))) for _ in range(3000))]
    for most in (500, 1 << 18):
        got = []
        for t in texts.slices(pa.array(said), most):
            flat, by = tokenizing.encode(t, VOCABULARY, tokenizing.ADDED)
            got += [flat[by[i] : by[i + 1]].tolist() for i in range(len(t))]
        assert got == [ids(s) for s in said]
    assert ids("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_packing_takes_the_added_token(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "one text.\n\n<|endoftext|>\n another"), (3, "<|endo"), (4, "ftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packed(docs, VOCABULARY).collect()}
    want = {d: np.array([*ids(t), 0], "<u4") for d, t in rows}
    assert got == {d: (len(w), zlib.crc32(w.tobytes())) for d, w in want.items()}
