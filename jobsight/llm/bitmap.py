"""A bitmap of 64-bit keys of fixed size (2 MB), whatever the number of keys.

It thins out rows before a shuffle and decides nothing: a key that is in the
set always passes, and a join behind it removes the others that do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24


def bitmap(keys: DataFrame, name: str) -> np.ndarray:
    """The bitmap of a long column, put together from at most 512 rows of 4 KB."""
    bit = F.pmod(name, F.lit(BITS)) + 1
    rows = (keys.select(F.bitmap_bucket_number(bit).alias("b"), F.bitmap_bit_position(bit).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (unsigned) have their bit set."""
    place = (keys & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
