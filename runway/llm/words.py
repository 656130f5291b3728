"""Vectorised work on the UTF-8 bytes of Arrow text columns: words, their hashes, byte n-grams.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  A word's 64-bit hash is a
polynomial over random byte values (any two words differ with probability 1 - 2**-58 or more).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; bounds the temporary arrays.
BLOCK_BYTES = 1 << 19

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)  # 5 modulo 8


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit integer over all."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def blocks(buf: np.ndarray, offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, bytes, offsets, whether the last row ends here) of runs of rows of at most ``most`` bytes.

    A longer row comes alone in several blocks, each cut where a separator stands, so no word is split.
    """
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        a, b = int(offsets[row]), int(offsets[end])
        while b - a > most:  # one long row
            cut = a + most
            while cut < b and not SPACE[buf[cut]]:
                step = np.flatnonzero(SPACE[buf[cut:min(b, cut + 4096)]])
                cut = cut + int(step[0]) if len(step) else min(b, cut + 4096)
            yield row, buf[a:cut], np.array([0, cut - a], dtype=np.int64), False
            a = cut
        yield row, buf[a:b], np.concatenate([[0], offsets[row + 1:end] - a, [b - a]]).astype(np.int64), True
        row = end


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of a block."""
    word = ~SPACE[buf]
    if not len(buf):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(buf))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the disjoint, ordered, non-empty spans."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
    values = _VALUES[buf[within + np.repeat(starts, lengths)]] * _powers(int(lengths.max()))[within]
    return mix64(np.add.reduceat(values, heads) + lengths.astype(np.uint64))


def word_hashes(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, word counts by row) of runs of whole rows, in order, rows never split."""
    held: list[np.ndarray] = []
    for row, part, offs, ended in blocks(*text_bytes(column), most):
        starts, ends, rows = word_bounds(part, offs)
        held.append(span_hashes(part, starts, ends))
        if ended:
            n = len(offs) - 1
            counts = np.bincount(rows, minlength=n).astype(np.int64)
            counts[0] += sum(map(len, held[:-1]))
            yield row, row + n, np.concatenate(held), counts
            held = []
