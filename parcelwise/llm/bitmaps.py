"""Bitmaps over hashed keys: a filter of bounded size that tasks use before a join, never instead of one.

A set bit can stem from another key, so a filter lets some rows through in vain; a key that was put in always passes.
With more keys than bits it lets everything through and the join still gives the right result.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27  # 8 kB to 16 MB


def bitmap(keys: DataFrame, column: str, keys_expected: int) -> Broadcast:
    """The bits of a long column, 32 or more for each key while 16 MB allow it. Comes to the driver as at most 2**21 pairs."""
    bits = LEAST_BITS
    while bits < min(32 * keys_expected, MOST_BITS):
        bits *= 2
    slot = F.col(column).bitwiseAND(bits - 1)
    words = (
        keys.where(F.col(column).isNotNull()).groupBy(F.shiftright(slot, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((`{column}` & {bits - 1}) & 63 AS int))")).alias("set")).toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[words["word"].to_numpy()] = words["set"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of some uint64 keys the filter lets through."""
    slot = keys & np.uint64(len(table) * 64 - 1)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
