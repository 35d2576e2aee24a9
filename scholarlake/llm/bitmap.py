"""A filter of fixed size for 64-bit hashes, made by Spark and sent to every task.

Two bits a hash, as in a Bloom filter: a hash that went in is always found,
others seldom.  Its size does not depend on how many hashes go in; with more of
them it lets more strangers pass, which a later exact join removes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24  # 2**24 bits are 2 MB


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of a column of longs, as 64-bit words; at most 2**bits / 64 rows are collected."""
    places = hashes.select(
        F.explode(
            F.array(
                F.col(column).bitwiseAND(F.lit((1 << bits) - 1)),
                F.shiftrightunsigned(column, 64 - bits),
            )
        ).alias("place")
    )
    rows = (
        places.groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("set"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return out


def found(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of these uint64 hashes may be in the filter."""
    bits = np.uint64(len(words).bit_length() - 1 + 6)
    low = hashes & np.uint64((1 << int(bits)) - 1)
    hit = (words[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) != 0
    some = np.flatnonzero(hit)
    high = hashes[some] >> np.uint64(64 - int(bits))
    hit[some] = (words[high >> np.uint64(6)] >> (high & np.uint64(63))) & np.uint64(1) != 0
    return hit
