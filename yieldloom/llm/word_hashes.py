"""Hashes of all words of a batch of texts at once, straight from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MULTIPLIER = 0x9E3779B97F4A7C15
# Bytes of text worked on at a time: bounds a task's memory.
STRETCH = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Words:
    """`hashes` of the words in order; document i has words first[i] up to first[i + 1]; word j is bytes start[j] to end[j] of `data`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all values and the offsets between them; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def word_hashes(column: pa.Array, lower: bool = False, seed: int = 0) -> Words:
    """Words are runs of bytes other than ASCII white space; `lower` turns A-Z into a-z first.

    A hash is a sum of keyed byte values times powers of an odd multiplier, modulo 2**64, then mixed with
    the length; equal words have equal hashes, other pairs share one with a chance of about 2**-64.
    """
    data, offsets = string_bytes(column)
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0], before[1:] = False, solid
    begins = solid & ~before[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = solid[edges]
    start = np.flatnonzero(begins)
    after = np.zeros(len(data), dtype=bool)
    if len(data):
        after[:-1] = ~solid[1:] | begins[1:]
        after[-1] = True
    end = np.flatnonzero(solid & after) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(data, start, end, first, np.zeros(0, np.uint64))
    lengths = end - start
    keys = np.random.default_rng(seed + 1).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()), np.uint64(MULTIPLIER + 2 * seed))]), dtype=np.uint64)
    packed = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(packed, lengths)
    hashes = np.add.reduceat(keys[data[solid]] * powers[place], packed)
    return Words(data, start, end, first, mixed(hashes + lengths.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def stretches(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about STRETCH bytes, a row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(column):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + STRETCH)))
        yield lo, hi
        lo = hi
