"""Static range asymmetric numeral system over token ids, in NumPy.

One frequency table (2**SCALE slots) is shared by all blocks. A block holds
its symbols on interleaved lanes (symbol i on lane i mod lanes); every
``EVERY`` rows of lanes a checkpoint keeps the lanes' states and the place in
the words, so that segments of a block decode independently; each segment has
a CRC-32 over its ids.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20
LOW = np.uint64(1 << 31)         # states lie in [2**31, 2**63)
WORD = np.uint64(32)
LANES = 1024
EVERY = 256                      # rows of lanes between checkpoints
_SHIFT = np.uint64(63 - SCALE)
_BITS = np.uint64(SCALE)
_SIZE = np.uint64(1 << SCALE)
_MASK = np.uint64((1 << SCALE) - 1)


@dataclass
class Table:
    freq: np.ndarray    # by symbol, sums to 2**SCALE
    start: np.ndarray
    symbol: np.ndarray  # by slot

    @classmethod
    def of(cls, freq: np.ndarray) -> "Table":
        freq = np.asarray(freq, np.uint64)
        start = np.concatenate([[np.uint64(0)], np.cumsum(freq)[:-1]]).astype(np.uint64)
        return cls(freq, start, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)))


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**SCALE; every counted symbol keeps a slot."""
    counts = np.asarray(counts, np.int64)
    size, total, used = 1 << SCALE, int(counts.sum()), int((counts > 0).sum())
    if used > size // 2:
        raise ValueError("more symbols than the table holds")
    if not used:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts / total * (size - used))), 0).astype(np.int64)
    freq[np.argmax(counts)] += size - int(freq.sum())
    return freq


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def lanes_for(n: int) -> int:
    return max(1, min(LANES, n // EVERY))


def encode(ids: np.ndarray, table: Table) -> dict:
    """A block: lanes, n, states (checkpoints x lanes), word_at, crc (by
    segment) and words."""
    n = len(ids)
    lanes = lanes_for(n)
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    words, count, states, at = [], 0, {}, {}
    for k in range(-(-steps // EVERY) - 1, -1, -1):
        segment = ids[k * EVERY * lanes:(k + 1) * EVERY * lanes]
        freq, start = table.freq.take(segment), table.start.take(segment)
        limit = freq << _SHIFT
        for a in range((len(segment) - 1) // lanes * lanes, -1, -lanes):
            f = freq[a:a + lanes]
            v = x[:len(f)]
            out = v >= limit[a:a + lanes]
            w = v.compress(out)
            if len(w):
                words.append(w.astype(np.uint32))
                count += len(w)
                np.right_shift(v, WORD, out=v, where=out)
            # (q << SCALE) + v % f + start, where q = v // f
            v += v // f * (_SIZE - f)
            v += start[a:a + lanes]
        states[k], at[k] = x.copy(), count
    segments = range(-(-steps // EVERY))
    return {"n": n, "lanes": lanes, "states": np.concatenate([states[k] for k in segments]).astype("<u8").tobytes(),
            "word_at": [count - at[k] for k in segments],
            "crc": [crc(ids[k * EVERY * lanes:(k + 1) * EVERY * lanes]) for k in segments],
            "words": np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""}


def decode_segment(block: dict, k: int, table: Table) -> np.ndarray:
    """The ids of segment ``k`` of a block; raises on a wrong checksum."""
    lanes, n = block["lanes"], block["n"]
    x = np.frombuffer(block["states"], "<u8", lanes, 8 * lanes * k).astype(np.uint64)
    words = np.frombuffer(block["words"], "<u4")
    pos = block["word_at"][k]
    lo, hi = k * EVERY * lanes, min(n, (k + 1) * EVERY * lanes)
    out = np.empty(hi - lo, np.uint32)
    for a in range(0, hi - lo, lanes):
        o = out[a:a + lanes]
        v = x[:len(o)]
        slot = v & _MASK
        o[:] = s = table.symbol.take(slot.view(np.int64))
        v >>= _BITS
        v *= table.freq.take(s)
        v += slot
        v -= table.start.take(s)
        need = np.flatnonzero(v < LOW)
        if len(need):
            v[need] = (v.take(need) << WORD) | words[pos:pos + len(need)]
            pos += len(need)
    if crc(out) != block["crc"][k]:
        raise ValueError("checksum mismatch")
    return out


def decode(block: dict, table: Table) -> np.ndarray:
    parts = [decode_segment(block, k, table) for k in range(len(block["word_at"]))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


def crc_join(a: int, b: int, b_bytes: int) -> int:
    """CRC-32 of two byte strings laid end to end from their CRC-32s and the
    length of the second: appending a zero bit is linear over GF(2), so its
    matrix is squared up to the wanted length."""
    step = [0xEDB88320] + [1 << k for k in range(31)]   # one zero bit (fixed polynomial of CRC-32)
    bits = 8 * b_bytes
    while bits:
        if bits & 1:
            a = _times(step, a)
        step = [_times(step, row) for row in step]
        bits >>= 1
    return a ^ b
