"""numpy kernels over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in runs of about so many bytes (a longer text is a run of its own).
RUN_BYTES = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is the empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)), at


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and row offsets (from 0) of consecutive runs of rows."""
    data, at = text_bytes(column)
    start = 0
    while start < len(at) - 1:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        stop = min(stop, len(at) - 1)
        yield start, stop, data[at[start] : at[stop]], at[start : stop + 1] - at[start]
        start = stop


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def is_white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray, white: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    inside = ~(is_white(data) if white is None else white)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POWERS: dict[int, np.ndarray] = {}
_BASE = 0x9E3779B97F4A7C15 | 1


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. n-1, modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length()) if n > 1 else 1 << 16
        have = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: polynomial prefix sums, scaled back to each span's start."""
    inverse = pow(_BASE, -1, 2**64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(len(data) + 1, inverse)[starts]
    return mixed(h + (ends - starts).astype(np.uint64))


def window_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes from each position on, by doubling; empty if there are fewer."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    level, size = data.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    while True:
        if k & size:
            out = level[:n].copy() if out is None else out * np.uint64(pow(_BASE, size, 2**64)) + level[done : done + n]
            done += size
        if done == k:
            return mixed(out)
        level = level[:-size] * np.uint64(pow(_BASE, size, 2**64)) + level[size:]
        size *= 2
