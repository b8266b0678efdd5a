"""Vectorised views of UTF-8 text for tasks: words, lines and hashes as numpy arrays.

A batch of texts is one byte buffer with offsets (Arrow's own layout).  Hashes of any
byte range come from prefix sums of ``table[byte] * r**position`` modulo the prime 2**61 - 1,
so a word, a line, a k-gram or a 400-byte window costs a subtraction and a multiplication.
The modulus is prime because a power of two has structured collisions whatever the base
(Thue-Morse strings); here two given strings of n bytes collide for at most n of the 2**61 bases.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_rng = np.random.RandomState(20240607)


def _wide(n: int) -> np.ndarray:
    return _rng.randint(0, 1 << 32, n, dtype=np.uint64) << np.uint64(32) | _rng.randint(
        0, 1 << 32, n, dtype=np.uint64)


#: The modulus, two independent byte tables and bases; seeded, so every worker has the same.
PRIME = (1 << 61) - 1
_P, _LOW = np.uint64(PRIME), np.uint64((1 << 32) - 1)
TABLES = [_wide(256) % _P, _wide(256) % _P]
BASES = [int(x) % PRIME for x in _wide(2)]
_BLOCK = 1 << 14

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for a and b below it, from products of halves."""
    a0, a1, b0, b1 = a & _LOW, a >> np.uint64(32), b & _LOW, b >> np.uint64(32)
    middle = a0 * b1
    middle += a1 * b0
    low = a0 * b0
    a1 *= b1
    a1 <<= np.uint64(3)  # 2**64 is 8
    a1 += low & _P
    low >>= np.uint64(61)
    a1 += low
    a1 += middle >> np.uint64(29)  # 2**32 * 2**29 is 1
    middle &= np.uint64((1 << 29) - 1)
    middle <<= np.uint64(32)
    a1 += middle
    return _below(a1)


def _below(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, in place."""
    high = x >> np.uint64(61)
    x &= _P
    x += high
    np.subtract(x, _P, out=x, where=x >= _P)
    return x


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_times`` block by block, in the cache."""
    out = np.empty(len(a), np.uint64)
    for lo in range(0, len(a), _BLOCK):
        out[lo: lo + _BLOCK] = _times(a[lo: lo + _BLOCK], b[lo: lo + _BLOCK])
    return out


@lru_cache(maxsize=2)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = BASES[which]
    out = []
    for b in (base, pow(base, -1, PRIME)):
        p = np.ones(size, np.uint64)
        done, step = 1, b
        while done < size:  # p[done + i] = p[i] * b**done
            n = min(done, size - done)
            p[done: done + n] = times(p[:n], np.full(n, step, np.uint64))
            done, step = done + n, step * step % PRIME
        out.append(p)
    return out[0], out[1]


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**0.. and r**-0.. for at least ``n`` positions."""
    return _powers(which, max(CHUNK_BYTES + 2, 1 << int(n).bit_length()))


def release() -> None:
    """Give memory that was freed back to the system: idle workers of a session otherwise
    keep the peak of their last task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(batches_: Iterator) -> Iterator:
    """The batches of a task; after the last one, memory that was freed goes back."""
    yield from batches_
    release()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def prefix(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums from which ``ranges`` takes hashes of ranges of ``values``."""
    power = powers(which, len(values) + 1)[0]
    p = np.zeros(len(values) + 1, np.uint64)
    total = 0
    for lo in range(0, len(values), _BLOCK):
        v = _below(values[lo: lo + _BLOCK].copy())
        v = _times(v, power[lo: lo + len(v)])
        # sums of halves stay far below 2**64; 2**32 times the upper sum, modulo the prime
        upper = np.cumsum(v >> np.uint64(32))
        v = np.cumsum(v & _LOW)
        v += upper >> np.uint64(29)
        upper &= np.uint64((1 << 29) - 1)
        upper <<= np.uint64(32)
        v += upper
        v += np.uint64(total)
        p[lo + 1: lo + 1 + len(v)] = _below(v)
        total = int(p[lo + len(v)])
    return p


def ranges(p: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each range [start, end); equal contents of equal length hash alike."""
    inv = powers(which, len(p))[1]
    out = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), _BLOCK):
        s, e = start[lo: lo + _BLOCK], end[lo: lo + _BLOCK]
        sums = _below(p[e] + (_P - p[s]))
        h = _times(sums, inv[s])
        h ^= (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        out[lo: lo + len(s)] = mix(h)
    return out


def batches(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows of about ``limit`` bytes;
    null counts as empty, and a longer text is a run of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    texts = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def rows_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row that holds each byte position."""
    return np.searchsorted(offsets, at, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; words never cross rows.  ``apart[byte]`` marks
    bytes outside words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    inside = ~apart[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends
