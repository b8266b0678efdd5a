"""Exact substring dedup: bytes covered by strings of ``length`` that start anywhere else.

Prefix doubling ranks positions by ever longer prefixes and drops a position as soon as
its rank is unique.  Ranking every byte of a corpus would shuffle many times its size,
so the first round ranks anchors only.  Every window of ``length`` bytes owns as anchor
the position of its least k-gram (k = length / 4; equal windows have equal k-grams at the
same place, so they have equal anchors), and an anchor owns a run of neighbouring
windows, its context:

1. k-grams: Spark groups the anchors by rank; a unique rank drops all its windows.
2. contexts: Spark groups the rest by (rank, context); windows of a context that occurs
   twice are repeated, and one copy of the context goes on to stand for the others.
3. positions: the windows of contexts that share an anchor with another context are
   ranked by pairs, (rank of h bytes here, rank of h bytes h further on), for h = k, 2k,
   reranked until unique or at ``length``.  Contexts meet by anchor in Spark; an anchor
   with more than ``most`` contexts is not gathered, its positions are grouped as rows.

Ranks are 64-bit names of their strings, so equal ranks mean equal strings and no global
renumbering is needed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import n_partitions, stored

CHUNK = 1 << 20
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks."""
    m = len(key)
    x = np.full(-(-m // width) * width, ~np.uint64(0))
    x[:m] = key
    x = x.reshape(-1, width)
    ahead = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(x, axis=1).ravel()
    return np.minimum(ahead[: m - width + 1], behind[width - 1: m])


def anchors_of(data: np.ndarray, off: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, anchor, k-gram rank, context rank) of the rows of a
    byte batch; positions count from the row's start."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none, none
    p = tb.prefix(tb.TABLES[0][data])
    at = np.arange(n - k + 1)
    gram = tb.ranges(p, at, at + k)
    low = np.uint64(max(20, int(n).bit_length()))
    place = (np.uint64(1) << low) - np.uint64(1)
    least = _least((gram & ~place) | at.astype(np.uint64), length - k + 1)
    anchor = (least & place).astype(np.int64)
    sizes = np.maximum(np.diff(off) - length + 1, 0)
    if not sizes.sum():
        return none, none, none, none, none, none
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + off[row]
    anchor = anchor[start]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    s0, s1 = start[first], start[np.append(first[1:], len(start)) - 1]
    a, row = anchor[first], row[first]
    context = tb.ranges(p, s0, s1 + length) ^ tb.mix((a - s0).astype(np.uint64) + _PAIR)
    base = off[row]
    return row, s0 - base, s1 - base, a - base, gram[a].view(np.int64), context.view(np.int64)


def _with_bytes(docs: DataFrame, key: str) -> DataFrame:
    """(_rid, key, packed text): a row's identity is its key and whole text; rows that
    repeat are equal in both and are judged alike."""
    def pack(it):
        c = zstandard.ZstdCompressor(level=1)
        for b in it:
            texts = [c.compress((t.as_py() or "").encode()) for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays([b.column("_rid"), b.column(key), pa.array(texts, pa.binary())],
                                             ["_rid", key, "_packed"])

    kind = docs.schema[key].dataType.simpleString()
    return _identified(docs, key).mapInArrow(pack, f"_rid long, `{key}` {kind}, _packed binary")


def _identified(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.xxhash64(F.col(key).cast("string"), F.col("text")).alias("_rid"), F.col(key),
                       F.col("text").alias("_text"))


def _anchors(docs: DataFrame, key: str, length: int) -> DataFrame:
    def run(it):
        for b in it:
            for lo, _, data, off in tb.batches(b.column("_text"), CHUNK):
                row, s0, s1, a, gram, context = anchors_of(data, off, length, length // 4)
                rid = np.asarray(b.column("_rid"))[lo + row]
                for x in range(0, len(row), 1 << 18):
                    part = slice(x, x + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram[part]), pa.array(context[part]), pa.array(rid[part]),
                         *[pa.array(v[part].astype(np.int32)) for v in (s0, s1 - s0, a - s0)]],
                        ["gram", "context", "rid", "s0", "width", "at"])

    return _identified(docs, key).select("_rid", "_text").mapInArrow(
        run, "gram long, context long, rid long, s0 int, width int, at int")


def _names(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, length: int, within=None) -> tuple[np.ndarray, np.ndarray]:
    """Names of the windows that begin at ``counts[i]`` positions from ``starts[i]``, by
    doubling; with ``within`` (a class per run) windows whose rank is unique in their class
    are dropped between rounds.  Returns (index of the run and place, names)."""
    run = np.repeat(np.arange(len(starts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[run]
    p = tb.prefix(tb.TABLES[0][text])
    h = length // 4
    every = np.arange(len(text) - h + 1)
    rank = tb.ranges(p, every, every + h)
    alive = np.arange(len(at))
    while h < length:
        step = min(h, length - h)
        pair = rank[: len(rank) - step] * _PAIR
        pair += rank[step:]
        rank, h = tb.mix(pair), h + step
        if within is not None and len(alive):
            alive = alive[_twins(within[run[alive]], rank[at[alive]])]
    return alive, rank[at[alive]]


def _twins(group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which (group, rank) occur more than once."""
    key = tb.mix(rank + group.astype(np.uint64) * _PAIR)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _runs(run: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of maximal runs of neighbouring places of one run."""
    if not len(run):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = (np.diff(run) != 0) | (np.diff(place) != 1)
    return np.flatnonzero(np.concatenate([[True], cut])), np.flatnonzero(np.concatenate([cut, [True]]))


def repeated_ranges(docs: DataFrame, key: str = "doc_id", length: int = 400, most: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(rows with packed text, byte ranges ``rid``, ``a``, ``b`` to remove)."""
    spark = docs.sparkSession
    parts = n_partitions(spark)
    anchors = stored(_anchors(docs, key, length), "repeats-anchors")
    contexts = anchors.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "s0", "width", "at")).alias("one"))
    by_gram = contexts.groupBy("gram").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1")
    held = stored(contexts.join(by_gram, "gram").select("gram", "context", "n", "kinds", "one.*"), "repeats-contexts")
    whole = held.filter("n > 1").select("gram", "context")
    sure = anchors.join(whole, ["gram", "context"], "left_semi").select(
        "rid", F.col("s0").alias("a"), (F.col("s0") + F.col("width") + length).alias("b"))
    open_ = (held.filter("kinds > 1").groupBy("rid").agg(
        F.collect_list(F.struct("gram", "kinds", "n", "s0", "width")).alias("open")))
    texts = _with_bytes(docs, key)
    # rows that repeat give their contexts once each; those have n > 1, so no window of
    # theirs is judged here, and others meet them all the same
    named = texts.join(open_, texts._rid == open_.rid)

    def cut(it):
        d = zstandard.ZstdDecompressor()
        for b in it:
            for rid, packed, rows in zip(*[b.column(c).to_pylist() for c in ("rid", "_packed", "open")]):
                text = d.decompress(packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["gram"] for r in rows], pa.int64()), pa.array([r["kinds"] for r in rows], pa.int64()),
                     pa.array([r["n"] for r in rows], pa.int64()), pa.array([rid] * len(rows), pa.int64()),
                     pa.array([r["s0"] for r in rows], pa.int32()),
                     pa.array([text[r["s0"]: r["s0"] + r["width"] + length] for r in rows], pa.binary())], names)

    names = ["gram", "kinds", "n", "rid", "s0", "bytes"]
    kinds = "gram long, kinds long, n long, rid long, s0 int, bytes binary"
    cuts = stored(named.select("rid", "_packed", "open").mapInArrow(cut, kinds), "repeats-open")

    def judge(it):
        """Classes arrive whole and in order; many small ones are judged together."""
        held_, size = [], 0
        for b in it:
            gram = np.asarray(b.column("gram"))
            edges = [0, *(np.flatnonzero(gram[1:] != gram[:-1]) + 1), len(gram)]
            for lo, hi in zip(edges, edges[1:]):
                if held_ and size > CHUNK and gram[lo] != held_[-1].column("gram")[-1].as_py():
                    yield _judged(held_)
                    held_, size = [], 0
                held_.append(b.slice(lo, hi - lo))
                size += sum(map(len, held_[-1].column("bytes").to_pylist()))
        if held_:
            yield _judged(held_)

    def _judged(held_):
        t = pa.Table.from_batches(held_)
        text, starts, counts = _joined(t.column("bytes").to_pylist())
        alive, _ = _names(text, starts, counts, length, np.asarray(t.column("gram")).view(np.uint64))
        run = np.repeat(np.arange(len(starts)), counts)[alive]
        place = alive - (np.cumsum(counts) - counts)[run]
        single = np.asarray(t.column("n"))[run] == 1
        run, place = run[single], place[single]
        first, last = _runs(run, place)
        rid, s0 = np.asarray(t.column("rid")), np.asarray(t.column("s0"))
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[run[first]]), pa.array((s0[run[first]] + place[first]).astype(np.int32)),
             pa.array((s0[run[last]] + place[last] + length).astype(np.int32))], ["rid", "a", "b"])

    def _joined(pieces):
        sizes = np.array([len(x) for x in pieces], np.int64)
        return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes - length + 1

    def positions(it):
        for b in it:
            for x in range(0, b.num_rows, 512):
                t = b.slice(x, 512)
                text, starts, counts = _joined(t.column("bytes").to_pylist())
                _, names_ = _names(text, starts, counts, length)
                run = np.repeat(np.arange(len(starts)), counts)
                at = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(t.column("gram"))[run]), pa.array(names_.view(np.int64)),
                     pa.array(np.asarray(t.column("n"))[run]), pa.array(np.asarray(t.column("rid"))[run]),
                     pa.array((np.asarray(t.column("s0"))[run] + at).astype(np.int32))],
                    ["gram", "name", "n", "rid", "a"])

    few = (cuts.filter(F.col("kinds") <= most).repartition(parts, "gram").sortWithinPartitions("gram")
           .mapInArrow(judge, "rid long, a int, b int"))
    found = few.unionByName(sure)
    many = cuts.filter(F.col("kinds") > most)
    if not many.isEmpty():
        rows = stored(many.mapInArrow(positions, "gram long, name long, n long, rid long, a int"), "repeats-positions")
        twice = rows.groupBy("gram", "name").count().filter("count > 1").select("gram", "name")
        found = found.unionByName(rows.filter("n = 1").join(twice, ["gram", "name"], "left_semi").select(
            "rid", "a", (F.col("a") + length).alias("b")))
    return texts, found


def dedup(docs: DataFrame, key: str = "doc_id", length: int = 400, most: int = 4096, with_text: bool = False) -> DataFrame:
    """Every row's ``key`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``
    of what is left, and the bytes left as ``kept`` if asked for.

    A null text is empty; texts shorter than ``length`` hold no such string.  Rows that
    repeat repeat each other's strings, so all lose them; an empty table gives an empty
    result.  Removal may cut inside a character: ``kept`` is binary.
    """
    texts, found = repeated_ranges(docs, key, length, most)
    spans = found.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))
    kind = docs.schema[key].dataType.simpleString()
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if with_text else 4]

    def run(it):
        d = zstandard.ZstdDecompressor()
        for b in it:
            out = []
            for packed, ranges in zip(b.column("_packed").to_pylist(), b.column("spans").to_pylist()):
                text, kept, end, spans_ = d.decompress(packed), [], 0, 0
                for r in ranges or ():
                    if r["a"] > end or not spans_:
                        kept.append(text[end: r["a"]])
                        spans_ += 1
                        end = r["b"]
                    else:
                        end = max(end, r["b"])
                kept.append(text[end:])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), spans_, hashlib.sha256(left).hexdigest(), left)[: len(names)])
            yield pa.RecordBatch.from_arrays([b.column(key), *[pa.array(x, t) for x, t in zip(
                list(zip(*out)) or [[]] * len(names), types)]], [key, *names])

    return texts.join(spans, texts._rid == spans.rid, "left").select(key, "_packed", "spans").mapInArrow(
        run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
