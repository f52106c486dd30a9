"""Token ids of whole texts, the same as the byte-level BPE tokenizer gives, at the cost of the distinct pieces.

A text is cut before every space or newline that follows a character which is not white space. No token crosses such a cut, because
the tokenizer's own split never joins a white-space character to what stands before it. An added token, where a caller names
one, is a piece of its own with its own id, and what stands before and behind it is cut and merged apart, as the tokenizer does. Each
distinct piece is encoded once for each Python worker while its bounded table has room, and ids are put together by array gathers.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

import numpy as np

from muster.llm import texts

TABLE = 150_000
#: Added tokens of byte_bpe_50k.json: a text's bytes and their id. No two places of such bytes may overlap.
ADDED = ((b"<|endoftext|>", 50256),)
_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x0A]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True


@functools.cache
def encoder(path: str):
    """The vocabulary file's encoder (ranks in base64), in which special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _known(path: str, added: tuple[tuple[bytes, int], ...]) -> dict[int, bytes]:
    return {}


def _places(t: texts.Texts, raw: bytes, mark: bytes) -> np.ndarray:
    """Where the bytes stand, each time within one text."""
    at = np.array([m.start() for m in re.finditer(re.escape(mark), raw)], np.int64)
    return at[np.searchsorted(t.off, at, "right") == np.searchsorted(t.off, at + len(mark) - 1, "right")]


def pieces(t: texts.Texts, raw: bytes = b"", added: tuple[tuple[bytes, int], ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces, and for each text its range of them."""
    d = t.data
    before, two, three = np.roll(d, 1), np.roll(d, 2), np.roll(d, 3)
    solid = _PLAIN[before] | ((before >= 0x80) & (two != 0xC2) & ((three < 0xE1) | (three > 0xE3)))
    cut = _CUT[d] & solid
    cut[t.off[:-1][np.diff(t.off) > 0]] = True
    for mark, _ in added:
        at = _places(t, raw, mark)
        cut[at] = True
        after = at + len(mark)
        cut[after[after < len(d)]] = True
    start = np.flatnonzero(cut)
    return start, np.searchsorted(start, t.off)


def encode(t: texts.Texts, path: str, added: tuple[tuple[bytes, int], ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a slice, and for each text its range of them. Without `added`, an added token is ordinary text."""
    raw = t.data.tobytes()
    start, by = pieces(t, raw, added)
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(len(t) + 1, np.int64)
    end = np.append(start[1:], len(t.data))
    h = texts.ranges(texts.prefix(t.data), start, end)
    names, first, which = np.unique(h, return_index=True, return_inverse=True)
    known, enc, own = _known(path, added), encoder(path), dict(added)
    if len(known) > TABLE:
        known.clear()
    coded = []
    for name, a, z in zip(names.tolist(), start[first].tolist(), end[first].tolist()):
        ids = known.get(name)
        if ids is None:
            piece = raw[a:z]
            ids = known[name] = array("I", [own[piece]] if piece in own else enc.encode_ordinary(piece.decode())).tobytes()
        coded.append(ids)
    flat = np.frombuffer(b"".join(coded), np.uint32)
    size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    n = size[which]
    until = np.cumsum(n)
    ids = flat[np.repeat(at[which] - (until - n), n) + np.arange(until[-1])]
    return ids, np.concatenate([[0], until])[by]
