"""A semi-Markov conditional random field over short token regions.

A region is a list of units; a segment is either one unit outside of everything or a
run of at most ``MOST`` units with a type.  The score of a typed segment is the sum of the
weights of its whole-span features, and of the transition from the type before it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence

MOST = 24

#: candidates of a region: for each end, (begin, type, features) of segments ending there
Lattice = list[list[tuple[int, str, tuple[str, ...]]]]


def _scores(lattice: Lattice, w: dict[str, float]) -> list[list[tuple[int, str, float]]]:
    return [[(i, t, sum(w.get(f, 0.0) for f in fs)) for i, t, fs in ends] for ends in lattice]


def _moves(w: dict[str, float], types: Sequence[str]) -> dict[tuple[str, str], float]:
    return {(a, b): w.get(f"{a}>{b}", 0.0) for a in types for b in types}


def decode(steps: Iterable[Sequence[tuple[int, str, tuple[str, ...]]]], w: dict[str, float],
           types: Sequence[str], every: int = 1024) -> Iterator[tuple[int, int, str]]:
    """The best segmentation's typed segments, in order; ``steps`` has the candidates of each
    end from 1 on, and types[0] is outside.

    Every ``every`` units the segments that all paths still open share are passed on and
    forgotten, so a region of any length is decoded whole, without a cut.
    """
    move, out = _moves(w, types), types[0]
    best: dict[int, dict[str, tuple[float, int, str]]] = {0: {out: (0.0, -1, "")}}

    def back(j: int, t: str) -> list[tuple[int, int, str]]:
        found = []
        while best[j][t][1] >= 0:
            _, i, before = best[j][t]
            if t != out:
                found.append((i, j, t))
            j, t = i, before
        return found[::-1]

    j = 0
    for j, ends in enumerate(steps, 1):
        here: dict[str, tuple[float, int, str]] = {}
        for i, t, s in [(j - 1, out, 0.0), *[(i, t, sum(w.get(f, 0.0) for f in fs)) for i, t, fs in ends]]:
            top = max((v[0] + move[a, t], a) for a, v in best[i].items())
            if t not in here or top[0] + s > here[t][0]:
                here[t] = (top[0] + s, i, top[1])
        best[j] = here
        if j % every == 0:
            open_ = {(p, t) for p in range(max(j - MOST, min(best)), j + 1) for t in best[p]}
            while len(open_) > 1:
                p, t = max(open_)
                open_.remove((p, t))
                open_.add(best[p][t][1:])
            [(p, t)] = open_
            yield from back(p, t)
            best = {k: v for k, v in best.items() if k > p} | {p: {t: (best[p][t][0], -1, "")}}
    yield from back(j, max(best[j], key=lambda a: best[j][a][0]))


def viterbi(lattice: Lattice, w: dict[str, float], types: Sequence[str]) -> list[tuple[int, int, str]]:
    """The best segmentation's typed segments; types[0] is outside."""
    return list(decode(lattice[1:], w, types))


def _add(a: float, b: float) -> float:
    if a == -math.inf:
        return b
    hi, lo = (a, b) if a > b else (b, a)
    return hi + math.log1p(math.exp(lo - hi))


def gradient(lattice: Lattice, gold: set[tuple[int, int, str]], w: dict[str, float], types: Sequence[str],
             into: dict[str, float]) -> float:
    """Add the gradient of the log likelihood of the gold segments; returns that likelihood."""
    move, scored, n, out = _moves(w, types), _scores(lattice, w), len(lattice), types[0]
    steps = [[]] + [[(j - 1, out, 0.0, ()), *[(i, t, s, lattice[j][k][2]) for k, (i, t, s) in enumerate(scored[j])]]
                    for j in range(1, n)]
    ahead: list[dict[str, float]] = [{out: 0.0}]
    for j in range(1, n):
        here: dict[str, float] = defaultdict(lambda: -math.inf)
        for i, t, s, _ in steps[j]:
            for a, v in ahead[i].items():
                here[t] = _add(here[t], v + move[a, t] + s)
        ahead.append(dict(here))
    back: list[dict[str, float]] = [defaultdict(lambda: -math.inf) for _ in range(n)]
    back[n - 1] = {t: 0.0 for t in types}
    for j in range(n - 1, 0, -1):
        for i, t, s, _ in steps[j]:
            if back[j].get(t, -math.inf) == -math.inf:
                continue
            for a in ahead[i]:
                back[i][a] = _add(back[i].get(a, -math.inf), move[a, t] + s + back[j][t])
    total = back[0][out]
    for j in range(1, n):
        for i, t, s, fs in steps[j]:
            after = back[j].get(t, -math.inf)
            if after == -math.inf:
                continue
            for a, v in ahead[i].items():
                p = math.exp(v + move[a, t] + s + after - total)
                if p > 1e-9:
                    into[f"{a}>{t}"] -= p
                    for f in fs:
                        into[f] -= p
    score, before, j = 0.0, out, 0
    begins = {i: (e, t) for i, e, t in gold}
    while j < n - 1:
        e, t = begins.get(j, (j + 1, out))
        into[f"{before}>{t}"] += 1
        score += move[before, t]
        if t != out:
            fs = next((fs for i, u, fs in lattice[e] if (i, u) == (j, t)), None)
            if fs is None:  # a gold segment that is no candidate stays outside
                e, t = j + 1, out
            else:
                for f in fs:
                    into[f] += 1
                    score += w.get(f, 0.0)
        before, j = t, e
    return score - total


def fit(examples: Sequence[tuple[Lattice, set[tuple[int, int, str]]]], types: Sequence[str], rounds: int = 25,
        rate: float = 0.5, l2: float = 1e-3, report: Callable[[float], None] | None = None) -> dict[str, float]:
    """Weights by full-batch ascent with per-weight step sizes (deterministic)."""
    w: dict[str, float] = defaultdict(float)
    size: dict[str, float] = defaultdict(float)
    for _ in range(rounds):
        g: dict[str, float] = defaultdict(float)
        likelihood = sum(gradient(lattice, gold, w, types, g) for lattice, gold in examples)
        for f, v in g.items():
            v = v / max(1, len(examples)) - l2 * w[f]
            size[f] += v * v
            w[f] += rate * v / (math.sqrt(size[f]) + 1e-8)
        if report:
            report(likelihood)
    return dict(w)
