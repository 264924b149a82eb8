"""Words of whole texts as NumPy arrays over Arrow buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (UTF-8 keeps
those bytes out of longer characters). Work runs in blocks of about a
megabyte, so memory does not grow with a batch; one long text is one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK = 1 << 20
LONG_WORD = 64  # longer words are hashed by digest
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.concatenate([[1], np.full(LONG_WORD, 0x100000001B3 ** 2 % (1 << 64) | 1)]).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``size`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of rows laid end to end, and the first
    word of each row (one more entry than rows). Offsets index ``raw``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi == lo:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~WHITE[raw[lo:hi]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets >= lo) & (offsets < hi)] - lo
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = cuts[cuts > 0] - 1
    last[ends] = inside[ends]
    s = np.flatnonzero(first) + lo
    e = np.flatnonzero(last) + lo + 1
    return s, e, np.searchsorted(s, offsets)


def word_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hashes of words; equal words hash alike in any task."""
    out = np.zeros(len(s), np.uint64)
    size = e - s
    total = np.cumsum(size)
    i = 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + BLOCK, "right")))
        keep = np.flatnonzero(size[i:j] <= LONG_WORD) + i
        if len(keep):
            n = size[keep]
            at = np.concatenate([[0], np.cumsum(n)[:-1]])
            pos = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(at, n)
            b = raw[np.repeat(s[keep], n) + pos]
            if lower:
                b = LOWER[b]
            h = np.add.reduceat((b.astype(np.uint64) + np.uint64(1)) * _POWERS[pos], at)
            out[keep] = mix(h + n.astype(np.uint64) * _MUL)
        for k in np.flatnonzero(size[i:j] > LONG_WORD) + i:
            b = raw[s[k]:e[k]]
            out[k] = int.from_bytes(hashlib.blake2b((LOWER[b] if lower else b).tobytes(), digest_size=8).digest(), "little")
        i = j
    return out


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-word windows of one text's word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for k in range(width):
        x = mix(x * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n])
    return x


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct window hashes; a shorter text is one shingle of all its
    words, a text without words has none."""
    if not len(h):
        return np.zeros(0, np.uint64)
    return np.unique(windows(h, min(width, len(h))))
