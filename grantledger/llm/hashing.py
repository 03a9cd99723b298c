"""64-bit hashes of words and word windows of whole columns of texts, in NumPy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_bytes(column: pa.Array, gap: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as UTF-8 with a gap byte after each, and the place of each text's end.

    Null counts as empty.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    ends = offsets[1:] - offsets[0]
    return np.insert(data, ends, gap), ends + np.arange(len(ends))


def word_hashes(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each run of bytes for which the table `is_word` holds."""
    inside = is_word[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    return starts, ends, hashes_of(data[inside], ends - starts)


def hashes_of(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of byte strings that follow each other in `data`."""
    if not len(sizes):
        return np.empty(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    powers = np.cumprod(np.full(int(sizes.max()), _ODD))
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    values = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
    return mixed(np.add.reduceat(values, first) + sizes.astype(np.uint64))


def same_bytes(data: np.ndarray, sizes: np.ndarray, like: np.ndarray) -> bool:
    """Whether each of the strings that follow each other in `data` equals the one whose number `like` gives."""
    if not len(sizes):
        return True
    if not np.array_equal(sizes, sizes[like]):
        return False
    first = np.cumsum(sizes) - sizes
    return np.array_equal(data, data[np.arange(len(data)) + np.repeat(first[like] - first, sizes)])
