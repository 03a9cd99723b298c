"""Directly addressable codes: numbers in chunk levels, any of which is read without decoding its neighbours.

The low bits of every number stand in the first level; a bit beside each chunk
says whether the number goes on in the next level, and the count of such bits
before it is the number's place there. Counts at every `BLOCK` bits (the rank
directory) leave at most one block of bits to be counted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits between two entries of a rank directory.
BLOCK = 512
#: Bytes at the end of a bit string, so that eight bytes can be read from each place.
SPARE = 8

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, one after the other, as bytes."""
    out = []
    for lo in range(0, len(values), 1 << 18):  # multiples of 8 values, so pieces end at whole bytes
        piece = np.ascontiguousarray(values[lo : lo + (1 << 18)], "<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(piece, axis=1, bitorder="little")[:, :width].ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(SPARE, np.uint8)])


def unpacked(data: np.ndarray, width: int, places: np.ndarray) -> np.ndarray:
    """The values at `places`, each from the eight bytes that hold it."""
    at = places * width
    held = np.lib.stride_tricks.sliding_window_view(data, 8)[at >> 3].copy().view("<u8").ravel()
    return (held >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


def directory(bits: np.ndarray) -> np.ndarray:
    """How many of the packed bits are set before each block."""
    blocks = -(-len(bits) // (BLOCK // 8))
    padded = np.zeros(blocks * (BLOCK // 8), np.uint8)
    padded[: len(bits)] = _ONES[bits]
    counts = padded.reshape(blocks, -1).sum(axis=1, dtype=np.uint32)
    return np.concatenate([np.zeros(1, np.uint32), np.cumsum(counts, dtype=np.uint32)])


def rank(bits: np.ndarray, before: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of set bits before each place: the directory's entry and the bits of one block."""
    out = np.empty(len(places), np.int64)
    for lo in range(0, len(places), 1 << 14):
        at = places[lo : lo + (1 << 14)]
        block = at // BLOCK
        whole = (at >> 3) - block * (BLOCK // 8)
        padded = np.lib.stride_tricks.sliding_window_view(bits, BLOCK // 8)[block * (BLOCK // 8)]
        inside = (_ONES[padded] * (np.arange(BLOCK // 8) < whole[:, None])).sum(axis=1, dtype=np.int64)
        rest = bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
        out[lo : lo + (1 << 14)] = before[block] + inside + _ONES[rest]
    return out


def widths(values: np.ndarray) -> list[int]:
    """Chunk widths, low bits first, that make the code shortest: a shortest path over the numbers of bits."""
    if not len(values):
        return [1]
    needed = np.maximum(np.ceil(np.log2(values.astype(np.float64) + 1)), 1).astype(np.int64)
    longest = int(needed.max())
    more = [int((needed > b).sum()) if b else len(values) for b in range(longest + 1)]  # numbers that go on beyond b bits
    best: list[tuple[float, list[int]]] = [(0.0, [])]
    for end in range(1, longest + 1):
        # all levels but the last have a bit beside each chunk, and the directory's share of one
        beside = 0 if end == longest else 1 + 32 / BLOCK
        best.append(min(
            (best[start][0] + more[start] * (end - start + beside), best[start][1] + [end - start]) for start in range(end)
        ))
    return best[longest][1]


@dataclass
class Level:
    width: int
    chunks: np.ndarray
    bits: np.ndarray | None  # None in the last level
    before: np.ndarray | None


def encode(values: np.ndarray) -> list[Level]:
    """The levels of unsigned 32-bit numbers."""
    levels = []
    parts = widths(values)
    for i, width in enumerate(parts):
        chunks = pack(values, width)
        if i + 1 == len(parts):
            levels.append(Level(width, chunks, None, None))
            break
        goes_on = (values >> np.uint32(width)) > 0
        bits = np.concatenate([np.packbits(goes_on, bitorder="little"), np.zeros(BLOCK // 8, np.uint8)])
        levels.append(Level(width, chunks, bits, directory(bits)))
        values = values[goes_on] >> np.uint32(width)
    return levels


def decode(levels: list[Level], places: np.ndarray) -> np.ndarray:
    """The numbers at `places`, each found by itself."""
    out = np.zeros(len(places), np.uint32)
    owner, at, shift = np.arange(len(places)), np.asarray(places, np.int64), 0
    for level in levels:
        out[owner] |= (unpacked(level.chunks, level.width, at) << np.uint64(shift)).astype(np.uint32)
        if level.bits is None:
            break
        on = (level.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        owner, at = owner[on], rank(level.bits, level.before, at[on])
        shift += level.width
    return out


def decode_range(levels: list[Level], start: int, end: int) -> np.ndarray:
    """The numbers from `start` to `end`: one rank a level finds where they begin, the next ones follow there."""
    out = np.zeros(end - start, np.uint32)
    owner, shift = np.arange(end - start), 0
    for level in levels:
        if not len(owner):
            break
        at = np.arange(start, start + len(owner), dtype=np.int64)
        first = int(start * level.width) >> 3
        last = (int((start + len(owner)) * level.width) >> 3) + SPARE
        bits = np.unpackbits(level.chunks[first:last], bitorder="little")
        skip = start * level.width - first * 8
        rows = bits[skip : skip + len(owner) * level.width].reshape(-1, level.width)
        whole = np.zeros((len(owner), 32), np.uint8)
        whole[:, : level.width] = rows
        chunks = np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()
        out[owner] |= chunks << np.uint32(shift)
        if level.bits is None:
            break
        on = (level.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        start = int(rank(level.bits, level.before, np.array([start], np.int64))[0])
        owner = owner[on]
        shift += level.width
    return out
