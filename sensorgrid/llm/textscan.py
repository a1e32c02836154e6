"""Words and hashes of many texts at once, as arrays over their UTF-8 bytes.

Used inside Arrow tasks. A column is cut into pieces of a few megabytes, so the
memory of a task depends on its longest text and not on the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 21

# An odd multiplier and the odd constants of a 64-bit finalizer.
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_CODES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    out = []
    for base in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(21, int(n).bit_length()))


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = column.buffers()
    at = np.frombuffer(raw[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes; a run ends with its row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(inside)]
    tails = offsets[1:][offsets[1:] > 0] - 1
    begin[heads] = inside[heads]
    end[tails] = inside[tails]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def prefix_hash(data: np.ndarray, codes: np.ndarray = _CODES) -> np.ndarray:
    """Sums whose differences are the polynomial hashes of spans."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of [begin, end), the same wherever the bytes stand."""
    back = powers(len(sums))[1]
    return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def shingle_hash(word: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words, from the words' hashes."""
    n = max(0, len(word) - size + 1)
    out = np.zeros(n, np.uint64)
    factor = np.uint64(MULTIPLIER)
    for k in range(size):
        out = out * factor + word[k : k + n]
    return mix(out)


def rows_of(begin: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row each position stands in."""
    return np.searchsorted(offsets, begin, "right") - 1


def segment_counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def sequence_hash(word: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [first, last), from the words' hashes."""
    forth, back = powers(len(word) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(word * forth[: len(word)], dtype=np.uint64)))
    return mix((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))
