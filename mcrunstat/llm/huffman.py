"""Canonical length-limited Huffman codes, and their vectorised bit packing and decoding."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Length of each symbol's code (0: not used), at most ``limit`` bits and of the least
    total size under that limit (package-merge)."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if not len(used):
        return out
    if len(used) == 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    now, leaves = weight, [np.ones(len(weight), bool)]
    for _ in range(limit - 1):
        pairs = now[: len(now) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        now = both[order]
        leaves.append(order < len(weight))
    lengths, take = np.zeros(len(used), np.uint8), 2 * len(used) - 2
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out[used] = lengths
    return out


class Code:
    """The canonical code of given lengths: codes by (length, symbol), and the table that
    maps the next ``width`` bits to a symbol and its length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        self.width = int(lengths.max()) if len(used) else 1
        order = used[np.lexsort((used, lengths[used]))]
        share = np.int64(1) << (self.width - self.lengths[order])
        begin = np.cumsum(share) - share
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (begin >> (self.width - self.lengths[order])).astype(np.uint64)
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.symbol[: share.sum()] = np.repeat(order, share)
        self.length = np.zeros(1 << self.width, np.uint8)
        self.length[: share.sum()] = np.repeat(self.lengths[order], share)

    def pack(self, symbols: np.ndarray, step: int) -> tuple[bytes, np.ndarray]:
        """The bits of the symbols, and the bit offset of every ``step``-th symbol."""
        n = self.lengths[symbols]
        at = np.cumsum(n) - n
        bits = int(at[-1] + n[-1]) if len(n) else 0
        word = at >> 5
        value = self.codes[symbols] << (64 - n - (at & 31)).astype(np.uint64)
        size = (bits + 31) // 32 + 1
        # bits of different symbols never meet, so sums of parts of a word stay below 2**32
        out = (np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
               + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)[:size])
        return out.astype(">u4").tobytes()[: (bits + 7) // 8], at[::step].astype(np.uint32)

    def unpack(self, blocks: list[tuple[bytes, np.ndarray, int]], step: int) -> list[np.ndarray]:
        """Symbols of blocks (bits, checkpoints, number of symbols): all runs between
        checkpoints of all blocks are decoded side by side."""
        base, lanes, sizes, pieces = 0, [], [], []
        for data, points, n in blocks:
            lanes.append(points.astype(np.int64) + 8 * base)
            sizes.append(np.minimum(step, n - step * np.arange(len(points))))
            pieces.append(data)
            base += len(data)
        buffer = np.frombuffer(b"".join(pieces) + bytes(4), np.uint8).astype(np.uint32)
        next32 = (buffer[:-3] << 24) | (buffer[1:-2] << 16) | (buffer[2:-1] << 8) | buffer[3:]
        at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
        size = np.concatenate(sizes) if sizes else at
        order = np.argsort(-size, kind="stable")
        at, live = at[order], len(order) - np.searchsorted(size[order][::-1], np.arange(step), "right")
        out = np.zeros((len(at), step), np.uint32)
        mask, shift = np.uint32((1 << self.width) - 1), 32 - self.width
        for k in range(step):
            m = live[k]
            if not m:
                break
            p = at[:m]
            seen = (next32[p >> 3] >> (shift - (p & 7)).astype(np.uint32)) & mask
            out[:m, k] = self.symbol[seen]
            at[:m] = p + self.length[seen]
        back = np.empty_like(out)
        back[order] = out
        flat, result, lane = back.reshape(-1), [], 0
        for _, points, n in blocks:
            result.append(flat[lane * step: lane * step + n])
            lane += len(points)
        return result
