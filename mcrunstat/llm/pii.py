"""Personal data: base patterns, and a semi-Markov field that adds spans they miss.

The base spans are found by rule in every whole text.  The field works on regions,
runs of tokens with a digit, an ``@`` or a spelt-out ``(at)``: it cuts a region into
units, scores every bounded run of units that could be an entity by features of the
whole span, and picks boundaries and types jointly.  Its spans are added where no base
span lies.  It is trained on the driver from the neighbourhoods of base spans, a bounded
number of each kind chosen by hash from all documents, and from rewritten forms of
generated values.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mcrunstat.llm import semicrf

KINDS = ("email", "ip", "card", "phone")
TYPES = ("out", *KINDS)

# The base patterns.  Possessive and look-behind forms match the same spans
# and keep long runs linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_CLUE = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
#: Whole tokens with a sign, one after another; every token is read once, without going back.
_REGION = re.compile(r"(?<!\S)[^\s0-9@\[(]*+[0-9@\[(]\S*+(?:[ \t][^\s0-9@\[(]*+[0-9@\[(]\S*+)*+")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[\[(](?:at|AT|dot|DOT|\.)[\])]|.", re.S)
_SPELT_AT, _SPELT_DOT = ("[at]", "(at)", "[AT]", "(AT)"), ("[dot]", "(dot)", "[DOT]", "(DOT)", "[.]", "(.)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base entities, by start and then kind as listed."""
    out: list[tuple[int, int, int]] = []
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and _LOCAL.match(text, begin - 1):
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            end = m.end()
            out.append((begin, 0, end))
        else:
            end = max(end, at)  # a later address cannot begin before this sign
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def _features(kind: str, span: str, left: str, right: str, units: list[str]) -> tuple[str, ...] | None:
    """Names of the features of a whole candidate span; None where it cannot be a ``kind``."""
    runs = [u for u in units if u[0] in "0123456789"]
    digits = "".join(runs)
    letters = sum(u.isalpha() and u.isascii() for u in units)
    out = [kind, f"{kind}|left {_around(left)}", f"{kind}|right {_around(right)}"]
    if kind == "email":
        at = span.count("@") + sum(u in _SPELT_AT for u in units)
        dots = span.count(".") + sum(u in _SPELT_DOT for u in units[1:]) - sum(u in ("[.]", "(.)") for u in units)
        if at != 1 or not letters or not (units[0].isalnum() and units[-1].isalpha()):
            return None
        out += [f"email|dots {min(dots, 3)}", f"email|spelt {'@' not in span}", f"email|spaces {min(span.count(' '), 4)}",
                f"email|end {min(len(units[-1]), 5)}", f"email|odd {any(not (u.isalnum() or u in '._%+-@ ' or u in _SPELT_AT + _SPELT_DOT) for u in units)}"]
    elif kind == "ip":
        if len(runs) != 4 or letters or not (units[0] in runs[:1] and units[-1] == runs[-1]) or len(units) != 7:
            return None
        marks = {u for u in units[1::2]}
        out += [f"ip|octets {all(len(r) <= 3 and int(r) <= 255 for r in runs)}",
                f"ip|marks {sorted(marks)[0] if len(marks) == 1 else 'mixed'}"]
    elif kind == "card":
        if not 12 <= len(digits) <= 19 or letters or units[0] not in runs or units[-1] not in runs:
            return None
        marks = {u for u in units if u not in runs}
        out += [f"card|luhn {luhn(digits)}", f"card|digits {len(digits)}",
                f"card|groups {'-'.join(str(len(r)) for r in runs) if len(runs) <= 6 else 'many'}",
                f"card|marks {'none' if not marks else sorted(marks)[0] if len(marks) == 1 else 'mixed'}"]
    else:
        if not 7 <= len(digits) <= 15 or letters or units[0][0] not in "+(0123456789" or units[-1] not in runs:
            return None
        out += [f"phone|plus {span[0] == '+'}", f"phone|digits {len(digits)}",
                f"phone|tail {'-'.join(str(len(r)) for r in runs[-3:])}", f"phone|paren {'(' in span and ')' in span}",
                f"phone|plain {len(runs) == 1}", f"phone|odd {any(not (u in runs or u in '+()-. ') for u in units)}",
                f"phone|closed {span.count('(') == span.count(')')}"]
    return tuple(out)


def _around(c: str) -> str:
    return "edge" if not c or c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def _steps(text: str, begin: int, end: int) -> Iterator[tuple[int, list[tuple[int, str, tuple[str, ...]]]]]:
    """For every unit of a region its end in the text and the candidates that end there."""
    units = ((m.group(), m.start(), m.end()) for m in _UNIT.finditer(text, begin, end))
    near = deque(islice(units, semicrf.MOST))
    found: deque[list] = deque([] for _ in near)
    i = 0
    while near:
        ahead = list(near)
        u, a, border = ahead[0]
        if not u.isspace() and u[0].isascii() and (u[0].isalnum() or u[0] in "+("):
            digits, at = 0, 0
            for n, (last, _, b) in enumerate(ahead):
                digits += len(last) if "0" <= last[0] <= "9" else 0
                at += last == "@" or last in _SPELT_AT
                if "\n" in last or digits > 60 or at > 1:
                    break
                if not last[-1].isalnum() or not (at or digits >= 4):
                    continue
                for kind in KINDS if at else KINDS[1:]:
                    if kind == "email" or not at:
                        f = _features(kind, text[a:b], text[a - 1: a], text[b: b + 1], [x[0] for x in ahead[:n + 1]])
                        if f:
                            found[n].append((i, kind, f))
        yield border, found.popleft()
        near.popleft()
        for x in islice(units, 1):
            near.append(x)
            found.append([])
        i += 1


def lattice(text: str, begin: int, end: int) -> tuple[semicrf.Lattice, list[int]]:
    """Candidates of a region and the text positions of its unit borders."""
    steps = list(_steps(text, begin, end))
    return [[], *[ends for _, ends in steps]], [begin, *[b for b, _ in steps]]


def _regions(text: str) -> list[tuple[int, int]]:
    """Runs of tokens with a clue, with one token more on either side of spelt-out signs."""
    out = []
    for m in _REGION.finditer(text):
        if not _CLUE.search(text, m.start(), m.end()):
            continue
        a, b = m.start(), m.end()
        if any(s in text[a:b] for s in _SPELT_AT):
            a = text.rfind(" ", max(0, a - 66), max(0, a - 1)) + 1 if a > 1 and text[a - 1] == " " else a
            a = max(a, m.start() - 66)
            tail = re.compile(r"(?: ?\S{1,64}){0,2}").match(text, b)
            b = tail.end() if tail else b
        out.append((a, b))
    return out


def model_spans(text: str, weights: dict[str, float]) -> list[tuple[int, str, int]]:
    out = []
    for a, b in _regions(text):
        borders = array("q", [a])

        def ends(a=a, b=b, borders=borders):
            for border, found in _steps(text, a, b):
                borders.append(border)
                yield found

        out += [(borders[i], t, borders[j]) for i, j, t in semicrf.decode(ends(), weights, TYPES)]
    return out


def all_spans(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """Base spans, and base spans with the field's spans that touch none of them."""
    if not _CLUE.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((a, b) for a, _, b in base)
    starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    added: list[tuple[int, str, int]] = []
    for a, t, b in sorted(set(model_spans(text, weights))):
        before = bisect_left(starts, b)  # base spans that begin before this one ends
        if (not before or reach[before - 1] <= a) and (not added or added[-1][2] <= a):
            added.append((a, t, b))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted([*base, *added], key=lambda s: (s[0], order[s[1]], s[2]))


def _neighbourhoods(texts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(kind, text around) of every base span of at most 200 characters."""
    for text in texts:
        for a, kind, b in base_spans(text):
            if b - a <= 200:
                lo = text.rfind(" ", max(0, a - 90), max(0, a - 30)) + 1 or max(0, a - 90)
                yield kind, text[lo: b + 30]


def _sample(docs: DataFrame, most: int) -> list[str]:
    """Of the neighbourhoods in all whole texts the ``most`` distinct ones of each kind with the
    smallest hashes.  A task keeps no more than that of a kind, so little travels."""
    def run(it):
        kept: dict[str, tuple[list, set]] = {k: ([], set()) for k in KINDS}
        for b in it:
            for kind, part in _neighbourhoods(b.column("text").to_pylist()):
                h = int.from_bytes(hashlib.blake2b(part.encode(), digest_size=8).digest(), "big") >> 1
                heap, seen = kept[kind]
                if (-h, part) in seen or (len(heap) >= most and -h < heap[0][0]):
                    continue
                seen.add((-h, part))
                heapq.heappush(heap, (-h, part))
                if len(heap) > most:
                    seen.discard(heapq.heappop(heap))
        rows = [(kind, -h, part) for kind, (heap, _) in kept.items() for h, part in heap]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            list(zip(*rows)) or [[]] * 3, (pa.string(), pa.int64(), pa.string()))], ["kind", "h", "part"])

    found = docs.filter(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(run, "kind string, h long, part string").distinct()
    place = F.row_number().over(Window.partitionBy("kind").orderBy("h", "part"))
    rows = found.withColumn("place", place).filter(F.col("place") <= most).collect()
    return [r.part for r in sorted(rows, key=lambda r: (r.kind, r.place))]


def _examples(parts: list[str], seed: int, generated: int) -> list[tuple[str, list[tuple[int, str, int]]]]:
    """Training texts with gold spans: the parts that hold base spans, and generated entities in
    usual and rewritten forms, and numbers that are none, between words of the parts."""
    rng = random.Random(seed)
    out = []
    for part in parts:
        gold, end = [], -1
        for x, k, y in base_spans(part):
            if x >= end:
                gold.append((x, k, y))
                end = y
        if gold:
            out.append((part, gold))
    words = sorted({w for t in parts for w in t.split() if w.isalpha()}) or ["word"]
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = rng.choice("3456") + d(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def ip() -> list[str]:
        return [str(rng.randrange(256)) for _ in range(4)]

    for _ in range(generated):
        w = lambda: rng.choice(words)
        name, host, top = rng.choice("abcdefgh") + d(1) + "name", "host" + d(1), rng.choice(["com", "org", "net", "de"])
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", ".")])
        c, p = card(), (d(3), "555", d(4))
        bad = c[:-1] + str((int(c[-1]) + 1 + rng.randrange(8)) % 10)
        kind, value = rng.choice([
            ("email", f"{name}@{host}.{top}"), ("email", f"{name}{at}{host}{dot}{top}"),
            ("ip", ".".join(ip())), ("ip", "[.]".join(ip())), ("ip", "(.)".join(ip())),
            ("card", c), ("card", " ".join(c[i: i + 4] for i in (0, 4, 8, 12))),
            ("card", ".".join(c[i: i + 4] for i in (0, 4, 8, 12))),
            ("phone", f"+1 ({p[0]}) {p[1]}-{p[2]}"), ("phone", f"({p[0]}) {p[1]}-{p[2]}"),
            ("phone", "-".join(p)), ("phone", ".".join(p)), ("phone", f"+{d(2)} {d(3)} {d(3)} {d(4)}"),
            ("", bad if not luhn(bad) else d(5)), ("", d(10)), ("", d(8)), ("", f"20{d(2)}-0{1 + rng.randrange(9)}-1{d(1)}"),
            ("", f"{d(1)}.{d(1)}.{d(2)}"), ("", f"{d(1)},{d(3)}.{d(2)}"), ("", f"{300 + rng.randrange(600)}.{d(2)}.{d(3)}.{d(2)}"),
            ("", "".join(rng.choice("0123456789abcdef") for _ in range(40))), ("", f"@{w()}"), ("", f"{w()} @ {d(2)}"),
            ("", f"{d(2)}:{d(2)}"), ("", d(20)), ("", f"{d(3)} {d(3)} {d(2)}"), ("", f"{d(4)} {d(4)}"),
        ])
        before = f"{w()} {w()} "
        out.append((f"{before}{value} {w()}", [(len(before), kind, len(before) + len(value))] if kind else []))
    return out


def train(docs: DataFrame, max_examples: int = 150, generated: int = 500, seed: int = 11, rounds: int = 25) -> dict[str, float]:
    """Weights from at most ``max_examples`` neighbourhoods of base spans of each kind, found in
    all whole texts and chosen by hash, and ``generated`` made-up entities; the same texts give
    the same weights.  Only these neighbourhoods travel to the driver."""
    examples = []
    for text, gold in _examples(_sample(docs, max_examples), seed, generated):
        regions = _regions(text)
        for a, b in regions:
            found, borders = lattice(text, a, b)
            at = {x: k for k, x in enumerate(borders)}
            own = {(at[x], at[y], k) for x, k, y in gold if x in at and y in at}
            if any(found):
                examples.append((found, own))
    return semicrf.fit(examples, TYPES, rounds)


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, weights: dict[str, float], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of every row with the number of base spans of each kind, the digest
    of the base spans, and all spans as text (code points, end exclusive).

    A null or empty text has no spans; repeated rows are searched each on its own; an empty
    table gives an empty result.
    """
    def run(it):
        for b in it:
            out = []
            for t in b.column("_text").to_pylist():
                base, every = all_spans(t or "", weights)
                kinds = [k for _, k, _ in base]
                out.append((*[kinds.count(k) for k in KINDS], hashlib.sha256(_joined(base).encode()).hexdigest(),
                            _joined(every)))
            types = [*[pa.int64()] * 4, pa.string(), pa.string()]
            cols = [pa.array(x, t) for x, t in zip(list(zip(*out)) or [[]] * 6, types)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in carry], *cols], [*carry, *names])

    names = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kinds_ = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in carry]
    return docs.select(*[F.col(f"`{k}`") for k in carry], F.col("text").alias("_text")).mapInArrow(
        run, ", ".join([*kinds_, *[f"n_{k} long" for k in KINDS], "base_sha256 string, spans string"]))
