"""Counting quotient filters over packed word-id n-grams.

Three word ids of ``b`` bits (0 for none) make one number of 3 b bits. A
Feistel network, which can be inverted, spreads these numbers evenly. The top
bits of the permuted number choose a range (a filter covers one range), the
next bits are the quotient, a slot of the filter, and all bits that are left
are kept as the remainder, so a filter loses nothing. A filter is stored as
the number of entries of every slot, the remainders in slot order, and one
byte a counter (larger counters go to a list). Entries are sorted, so filters
of one range are merged like sorted runs.

Permuted numbers travel as two halves of ``h`` bits each, ``left`` on top.
"""

from __future__ import annotations

import numpy as np

from . import text as T

ROUND_KEYS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], np.uint64)
RANGE_BITS = 9          # a filter is split into 512 ranges at a time
ESCAPE = 255


def half_bits(b: int) -> int:
    return (3 * b + 1) // 2


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permute(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Permuted halves of packed ids (each below 2 ** b, b at most 42)."""
    h = half_bits(b)
    low, u = h - b, np.uint64
    left = (w1.astype(u) << u(2 * b - h)) | (w2.astype(u) >> u(low))
    right = ((w2.astype(u) & _mask(low)) << u(b)) | w3.astype(u)
    for key in ROUND_KEYS:
        left, right = right, left ^ (T.mix(right + key) & _mask(h))
    return left, right


def unpermute(left: np.ndarray, right: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = half_bits(b)
    low, u = h - b, np.uint64
    for key in ROUND_KEYS[::-1]:
        left, right = right ^ (T.mix(left + key) & _mask(h)), left
    return left >> u(2 * b - h), (right >> u(b)) | ((left & _mask(2 * b - h)) << u(low)), right & _mask(b)


def summed(left: np.ndarray, right: np.ndarray, n: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, equal ones added up. Sorted runs laid end to end are
    merged by the stable sort."""
    if 2 * h <= 64:
        order = np.argsort((left << np.uint64(h)) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, n = left[order], right[order], n[order]
    if not len(left):
        return left, right, n
    first = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
    return left[first], right[first], np.add.reduceat(n, first)


def _narrow(x: np.ndarray, bits: int) -> bytes:
    size = (bits + 7) // 8
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _wide(raw: bytes, count: int, bits: int) -> np.ndarray:
    size = (bits + 7) // 8
    out = np.zeros((count, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(count, size)
    return out.view("<u8").ravel().astype(np.uint64)


def encode(left: np.ndarray, right: np.ndarray, n: np.ndarray, h: int, used: int) -> bytes:
    """The filter of sorted entries that agree on their ``used`` top bits."""
    count, u = len(left), np.uint64
    q = min(h - used, max(1, int(count).bit_length() - 1))
    rest = h - used - q
    inside = left & _mask(h - used)
    slots = np.bincount((inside >> u(rest)).astype(np.int64), minlength=1 << q)
    width = 1 if slots.max(initial=0) < 256 else 4
    tail = inside & _mask(rest)
    together = rest + h <= 64
    bits = [rest + h] if together else [rest, h]
    parts = [(tail << u(h)) | right] if together else [tail, right]
    large = n[n >= ESCAPE].astype("<u8")
    head = np.array([count, q, width, len(large)], "<i8").tobytes()
    return b"".join([head, slots.astype(f"<u{width}").tobytes(), *map(_narrow, parts, bits),
                     np.minimum(n, ESCAPE).astype(np.uint8).tobytes(), large.tobytes()])


def decode(raw: bytes, h: int, used: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a filter whose ``used`` top bits are ``prefix``."""
    count, q, width, n_large = np.frombuffer(raw, "<i8", 4).tolist()
    u, at, rest = np.uint64, 32, h - used - q
    slots = np.frombuffer(raw, f"<u{width}", 1 << q, at)
    at += width << q
    together = rest + h <= 64
    parts = []
    for bits in [rest + h] if together else [rest, h]:
        size = count * ((bits + 7) // 8)
        parts.append(_wide(raw[at:at + size], count, bits))
        at += size
    tail, right = (parts[0] >> u(h), parts[0] & _mask(h)) if together else parts
    n = np.frombuffer(raw, np.uint8, count, at).astype(np.int64)
    n[n == ESCAPE] = np.frombuffer(raw, "<u8", n_large, at + count)
    quotient = np.repeat(np.arange(1 << q, dtype=u), slots)
    left = (u(prefix) << u(h - used)) | (quotient << u(rest)) | tail
    return left, right, n


def merge(filters: list[bytes], h: int, used: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of several filters of one range, counters added up."""
    parts = [decode(f, h, used, prefix) for f in filters]
    return summed(*(np.concatenate(x) for x in zip(*parts)), h)


def split(left: np.ndarray, right: np.ndarray, n: np.ndarray, h: int, used: int, more: int | None = None) -> list[tuple[int, bytes]]:
    """One filter for each range of ``more`` (RANGE_BITS) further bits that has entries."""
    bits = used + (RANGE_BITS if more is None else more)
    top = (left >> np.uint64(h - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(top, prepend=-1))
    ends = np.append(cuts[1:], len(top))
    return [(int(top[i]), encode(left[i:j], right[i:j], n[i:j], h, bits)) for i, j in zip(cuts, ends)]
