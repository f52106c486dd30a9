"""Fixed-size bitmaps of 64-bit keys, to pass over rows that cannot match before an exact join.

Two bits a key in a map whose size is a parameter, so what is collected and broadcast has the same bound at every input
size. A full map lets more rows through to the join; it never drops a match.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def _two(key: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1)
    return [key.bitwiseAND(mask), F.shiftrightunsigned(key, 63 - bits).bitwiseAND(mask)]


def build(df: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The map as 2^bits / 64 words; at most that many rows reach the driver, whatever `df` holds."""
    places = df.select(F.explode(F.array(*_two(F.col(key), bits))).alias("p"))
    one = F.lit(1).cast("long")
    words = places.groupBy((F.col("p") / 64).cast("long").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", one, F.pmod("p", F.lit(64)).cast("int"))).alias("v")
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    for w, v in words.collect():
        out[w] = v
    return out.view(np.uint64)


def has(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the map; False where it surely is not."""
    bits = int(np.log2(len(words))) + 6
    mask = np.uint64((1 << bits) - 1)
    out = np.ones(len(keys), bool)
    for p in (keys & mask, (keys >> np.uint64(63 - bits)) & mask):
        out &= (words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out
