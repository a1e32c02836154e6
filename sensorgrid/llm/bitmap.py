"""Sets of 64-bit hashes as bitmaps of a bounded size, small enough to broadcast at any scale.

A member is always found; others pass by chance, more of them the fuller the bitmap.
Only for filters before an exact step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITMAP_BITS = 25
#: Bits of the largest bitmap: 64 MB.
MOST_BITS = 29


def fitting(keys: int) -> int:
    """Bits with which about one in sixteen of others passes, up to the largest bitmap."""
    return min(MOST_BITS, max(20, (16 * keys).bit_length()))


def bitmap(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for every value of the one long column; ``2**bits`` bits, whatever the input."""
    key = F.col(keys.columns[0])
    word = F.shiftrightunsigned(key, 64 - bits + 6).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{keys.columns[0]}`, {64 - bits}) & 63 as int))")
    rows = keys.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("word").to_numpy().astype(np.int64)] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key >> np.uint64(64 - (len(bits).bit_length() + 5))
    return ((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
