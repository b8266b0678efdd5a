"""Gradient-boosted trees for bounded training sets: histogram growth with monotonic
constraints, flattened into node arrays and scored for many rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees in one set of arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row; all trees step down together."""
        total = np.full(len(x), self.base)
        if not len(self.roots):
            return total
        for lo in range(0, len(x), 4096):
            part = x[lo: lo + 4096]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                down = part[row, self.feature[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            total[lo: lo + 4096] += self.value[node].sum(1)
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 3,
        rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: int = 5) -> Trees:
    """Boosted logistic loss.  ``monotone[f]`` is +1 / -1 where the log odds may only rise /
    fall with feature f, else 0: a split of f against its sign is not taken, and children
    are bounded by the middle of their parents' values, so every tree keeps the sign.
    Rows of one class, or none, give a constant."""
    n, width = x.shape
    rate_of = float(np.clip((y.sum() + 0.5) / (n + 1), 1e-3, 1 - 1e-3))
    base = float(np.log(rate_of / (1 - rate_of)))
    nodes: list[list] = []
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            step = np.zeros(n)

            def grow(rows, level, low, high):
                g, h = grad[rows].sum(), hess[rows].sum()
                own = float(np.clip(-g / (h + l2), low, high))
                best = (1e-6, None)
                if level < depth and len(rows) >= 2 * least:
                    for f in range(width):
                        if not len(cuts[f]):
                            continue
                        k = len(cuts[f]) + 1
                        b = binned[rows, f]
                        gl = np.cumsum(np.bincount(b, grad[rows], k))[:-1]
                        hl = np.cumsum(np.bincount(b, hess[rows], k))[:-1]
                        nl = np.cumsum(np.bincount(b, minlength=k))[:-1]
                        vl = np.clip(-gl / (hl + l2), low, high)
                        vr = np.clip(-(g - gl) / (h - hl + l2), low, high)
                        gain = gl**2 / (hl + l2) + (g - gl)**2 / (h - hl + l2) - g**2 / (h + l2)
                        bad = (nl < least) | (len(rows) - nl < least) | (monotone[f] * (vr - vl) < 0)
                        gain = np.where(bad, 0, gain)
                        at = int(gain.argmax())
                        if gain[at] > best[0]:
                            best = (gain[at], (f, at, vl[at], vr[at]))
                me = len(nodes)
                nodes.append([0, np.inf, me, me, own * rate])
                if best[1] is None:
                    step[rows] = own * rate
                    return me
                f, at, vl, vr = best[1]
                mid = (vl + vr) / 2
                left_high, right_low = (mid, mid) if monotone[f] > 0 else (high, low)
                left_low, right_high = (mid, mid) if monotone[f] < 0 else (low, high)
                down = binned[rows, f] <= at
                left = grow(rows[down], level + 1, left_low, left_high)
                right = grow(rows[~down], level + 1, right_low, right_high)
                nodes[me] = [f, cuts[f][at], left, right, 0.0]
                return me

            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
            margin += step
    cols = list(zip(*nodes)) if nodes else [[]] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Trees(*[np.array(c, k) for c, k in zip(cols, kinds)], np.array(roots, np.int64), base, depth)
