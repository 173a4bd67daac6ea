"""A broadcast filter of 64-bit hashes whose size has a bound (a Bloom filter of two bits per key).

What is wanted is often known only by the data, and the rows that may hold it are the whole corpus.
The filter lets workers leave out nearly all of what nobody asks for before it is shuffled; an exact
join decides on what passes. With more keys than it is sized for, more passes and nothing is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per key; of other hashes less than 1 % pass.
BITS_PER_KEY = 32
_ONE = np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def filter_of(keys: DataFrame, column: str, most: int) -> np.ndarray:
    """Words of the filter over a column of well spread hashes, sized for the keys there are, for ``most`` at the greatest.

    At most ``most * BITS_PER_KEY`` bits (to the next power of two) reach the driver, whatever the keys.
    """
    size = 6
    count = min(keys.count(), most)
    while 1 << size < count * BITS_PER_KEY:
        size += 1
    mask = F.lit((1 << size) - 1).cast("bigint")
    key = F.col(column)
    places = keys.select(F.explode(F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask))).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    rows = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    words = np.zeros(1 << (size - 6), dtype=np.uint64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return words


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the hashes (uint64)."""
    mask = np.uint64(len(words) * 64 - 1)
    first = hashes & mask
    found = (words[first >> np.uint64(6)] >> (first & np.uint64(63))) & _ONE
    at = np.flatnonzero(found)
    second = (hashes[at] >> np.uint64(32)) & mask
    out = np.zeros(len(hashes), dtype=bool)
    out[at] = (words[second >> np.uint64(6)] >> (second & np.uint64(63))) & _ONE
    return out
