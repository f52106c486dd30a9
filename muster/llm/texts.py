"""Whole batches of texts as byte arrays: word boundaries and 64-bit hashes without a Python loop over words.

A batch of an Arrow string column is one UTF-8 buffer with offsets. Words are maximal runs of "word" bytes of a 256-entry
table, cut at text borders; every separator used here is ASCII, so byte runs and character runs are the same.
Slices are bounded in bytes (one text alone may exceed the bound), so memory stays flat whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(separators: bytes) -> np.ndarray:
    """True for bytes that belong to words."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


#: Words of [^\x20\x09-\x0D]+, of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, and the pieces between newlines.
SPACED = table(b" \t\n\x0b\x0c\r")
ALNUM = table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Texts:
    """A slice of a batch. `off` has len(texts) + 1 entries into `data`."""

    data: np.ndarray
    off: np.ndarray
    first: int  # row of the batch that the slice starts with

    def __len__(self) -> int:
        return len(self.off) - 1


@dataclass
class Words:
    """Byte ranges of the words of a slice, and for each text its range of words (`by` has len(texts) + 1 entries)."""

    start: np.ndarray
    end: np.ndarray
    by: np.ndarray

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.by) - 1), np.diff(self.by))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column cut into slices of at most `most` bytes, or of a single longer text. Nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield Texts(data[off[i] : off[j]], off[i : j + 1] - off[i], i)
        i = j


def words(t: Texts, kind: np.ndarray) -> Words:
    w = kind[t.data]
    begins = w.copy()
    begins[1:] &= ~w[:-1]
    ends = w.copy()
    ends[:-1] &= ~w[1:]
    full = np.flatnonzero(np.diff(t.off))
    begins[t.off[full]] = w[t.off[full]]
    ends[t.off[full + 1] - 1] = w[t.off[full + 1] - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, t.off))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that all their bits count."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes, from which `ranges` takes the hash of any byte range."""
    n = len(data) + 1
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n + (n >> 2), base)]))
    out = np.zeros(n, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][: n - 1], out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each byte range; equal bytes give equal hashes, whatever the slice."""
    return mix((sums[end] - sums[start]) * _powers[1][start])


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive values, from each position on that has k - 1 more behind it."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out + h[i : n + i]) * _BASE
        out ^= out >> np.uint64(29)
    return mix(out)


def inside(by: np.ndarray, k: int) -> np.ndarray:
    """Positions from which k consecutive words lie in one text."""
    left = np.repeat(by[1:], np.diff(by)) - np.arange(by[-1])
    return np.flatnonzero(left >= k)


def totals(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Sums of each text's values."""
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return sums[by[1:]] - sums[by[:-1]]


def int64(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
