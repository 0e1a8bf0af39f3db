"""A set of 64-bit keys as bits of a fixed number, for ruling out rows before a shuffle.

A key whose bit is not set is not in the set. Others may be: what passes is joined with
the keys themselves. The bits are BITS / 8 bytes at any number of keys, so they can go
to all tasks; with very many keys they rule out less, which costs a larger shuffle and
no row.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def bitmap(keys: DataFrame, column: str) -> Broadcast:
    """The bits of all values of a long column, put together in the cluster by words of 64."""
    places = keys.select(F.pmod(F.col(column), F.lit(BITS)).cast("int").alias("bit"))
    words = places.selectExpr("bit div 64 AS word", "shiftleft(1L, bit % 64) AS bits")
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(out)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the set."""
    bit = keys.view(np.uint64) % np.uint64(BITS)
    return ((bits.view(np.uint64)[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
