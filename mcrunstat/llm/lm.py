"""Interpolated modified Kneser-Ney model: counted in Spark, stored as sorted hash arrays.

Three passes over the corpus: words (hash -> count), word pairs (ids packed into one
long -> count), scores.  The model is two sets of memory-mapped arrays: the vocabulary
(sorted word hashes, and for each word its count, its sums as a context and its number
of left neighbours) and the pairs (sorted keys with counts).  A word's id is its place
in the sorted vocabulary.  Nothing of the size of the corpus passes through the driver:
it sees the number of words of each shard and the counts of counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm import hasharrays as ha
from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import n_partitions, scratch, stored

#: Hashes of the end token and of the start context; no word hashes are reserved, a word
#: meets them as rarely as it meets another word's hash (64 bits).
END, START = np.uint64(0x5EED0E0D0E0D0E0D), np.uint64(0x5EED57A457A457A4)
HOT_CONTEXTS = 1024
SPLIT = 64
FLUSH = 600_000


class _Sums:
    """Counts by key, merged as they come and handed out when they are many."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.parts, self.size = [], 0
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every token: lower-cased words, then one end per row."""
    start, end = tb.words(data, off)
    n = len(off) - 1
    p = tb.prefix(tb.TABLES[0][tb.LOWER[data]]) if len(data) else np.zeros(1, np.uint64)
    row = np.concatenate([tb.rows_of(off, start), np.arange(n)])
    h = np.concatenate([tb.ranges(p, start, end), np.full(n, END)])
    order = np.argsort(row, kind="stable")
    return row[order], h[order]


def _before(row: np.ndarray, ids: np.ndarray, start) -> np.ndarray:
    """The token before each token of its row, ``start`` for the first."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[np.concatenate([[True], row[1:] != row[:-1]])] = start
    return out


class Vocabulary:
    """Ids of word hashes: sorted arrays by the top bits of the hash."""

    def __init__(self, folder: str, bases: np.ndarray, bits: int):
        self.folder, self.bases, self.bits = folder, bases, bits

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        unique, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(unique), -1, np.int64)
        shard = (unique >> np.uint64(64 - self.bits)).astype(np.int64)
        edges = np.searchsorted(shard, np.arange((1 << self.bits) + 1))
        for s in np.unique(shard):
            part = slice(edges[s], edges[s + 1])
            at = ha.find(ha.load(self.folder, "hash", int(s)), unique[part])
            out[part] = np.where(at >= 0, at + self.bases[s], -1)
        return out[back]

    def facts(self, field: str, ids: np.ndarray, absent=0.0) -> np.ndarray:
        """A fact of each id; ``absent`` for unknown words."""
        unique, back = np.unique(ids, return_inverse=True)
        out = np.full(len(unique), absent, np.float64)
        edges = np.searchsorted(unique, self.bases)
        for s in range(len(self.bases) - 1):
            part = unique[edges[s]: edges[s + 1]]
            held = ha.load(self.folder, field, s) if len(part) else None
            if held is not None:  # a shard without a word in any pair has no such facts
                out[edges[s]: edges[s + 1]] = held[part - self.bases[s]]
        return out[back]


def _shard(u: np.ndarray, w: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """Pairs of one context share a shard; those of the most frequent contexts are split."""
    salt = np.where(np.isin(u, hot), 1 + w % SPLIT, 0)
    return ((u * 40503 + salt * 30011) >> 4) % shards


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of items seen 1 to 4 times; without such numbers the
    usual middle values."""
    if min(n) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05 * k), float(k)) for k in (1, 2, 3)]


def _write_groups(it, fields):
    """Batches sorted by shard as (shard, columns) of whole shards."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in it:
        shard = np.asarray(b.column("shard"))
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if now is not None and shard[lo] != now:
                yield now, [np.concatenate([np.asarray(x.column(f)) for x in held]) for f in fields]
                held = []
            now = int(shard[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield now, [np.concatenate([np.asarray(x.column(f)) for x in held]) for f in fields]


class Model:
    """Counts of words and pairs with their discounts.  What workers need to score; the arrays stay in the shared folder."""

    def __init__(self, vocabulary, pairs, shards, hot, start, discounts, unigram):
        self.vocabulary, self.pairs, self.shards, self.hot = vocabulary, pairs, shards, hot
        self.start, self.discounts = start, discounts
        self.train_tokens, self.words, self.kinds, self.low_discounts, self.low_rest = unigram

    def _discount(self, c: np.ndarray, d: list[float]) -> np.ndarray:
        return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]

    def pair_counts(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(u), np.float64)
        known = np.flatnonzero((u >= 0) & (w >= 0))
        key = u[known] << 32 | w[known]
        unique, back = np.unique(key, return_inverse=True)
        shard = _shard(unique >> 32, unique & 0xFFFFFFFF, self.hot, self.shards)
        got = np.zeros(len(unique), np.float64)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.unique(shard):
            part = order[edges[s]: edges[s + 1]]
            at = ha.find(ha.load(self.pairs, "key", int(s)), unique[part])
            hit = at >= 0
            if hit.any():
                got[part[hit]] = ha.load(self.pairs, "count", int(s))[at[hit]]
        out[known] = got[back]
        return out

    def score(self, row: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
        v = self.vocabulary
        ids = v.ids(hashes)
        c = v.facts("n", ids)
        base = np.log10((c + 0.5) / (self.train_tokens + 0.5 * (self.words + 1)))
        left = v.facts("left", ids)
        low = (left - self._discount(left, self.low_discounts)) / max(self.kinds, 1) + self.low_rest / (self.words + 1)
        u = _before(row, ids, self.start)
        total = v.facts("total", u)
        pair = self.pair_counts(u, ids)
        kept = sum(d * v.facts(f, u) for d, f in zip(self.discounts, ("n1", "n2", "n3")))
        seen = total > 0
        below = np.maximum(total, 1)
        p = np.where(seen, (pair - self._discount(pair, self.discounts)) / below + kept / below * low, low)
        per = lambda x: np.bincount(row, x, n)
        return [per(None), per(c > 0).astype(np.int64), per(base), per(np.log10(p))]


def train(docs: DataFrame) -> Model:
    """Count and store the model of the texts of ``docs`` (null: empty)."""
    spark = docs.sparkSession
    parts = n_partitions(spark)
    bits = max(4, math.ceil(math.log2(parts)) + 1)
    texts = docs.select(F.col("text").alias("_text"))

    def count_words(it):
        sums = _Sums()

        def out():
            k, c = sums.merged()
            shard = (k >> np.uint64(64 - bits)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(k.view(np.int64)), pa.array(c)],
                                              ["shard", "hash", "n"])

        for b in it:
            for _, _, data, off in tb.batches(b.column("_text")):
                sums.add(*np.unique(_tokens(data, off)[1], return_counts=True))
                if sums.size > FLUSH:
                    yield out()
        if sums.parts:
            yield out()

    def write_words(it):
        for shard, (h, n) in _write_groups(it, ("hash", "n")):
            h = h.view(np.uint64)
            order = np.argsort(h)
            ha.save(words_at, "hash", shard, h[order])
            ha.save(words_at, "n", shard, n[order])
            # hashes spread the frequent words over the shards; a miss costs balance only
            top = np.argsort(-n)[: 8 + 4 * HOT_CONTEXTS // (1 << bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(h)]), pa.array([int(n.sum())]), pa.array([int((n > 0).sum())]),
                 pa.array([h[top].view(np.int64)], pa.list_(pa.int64())), pa.array([n[top]], pa.list_(pa.int64()))],
                ["shard", "size", "tokens", "words", "top", "top_n"])

    words_at = scratch(spark, "lm-words")
    found = texts.mapInArrow(count_words, "shard int, hash long, n long")
    extra = spark.createDataFrame(
        [(int(x >> np.uint64(64 - bits)), int(x.astype(np.int64)), 0) for x in (END, START)], "shard int, hash long, n long")
    words = (found.unionByName(extra).repartition(parts, "shard").groupBy("shard", "hash").agg(F.sum("n").alias("n"))
             .sortWithinPartitions("shard"))
    sizes = stored(words.mapInArrow(write_words, "shard int, size long, tokens long, words long, top array<long>, "
                                                 "top_n array<long>"), "lm-sizes")
    rows = sizes.select("shard", "size", "tokens", "words").collect()  # one row a shard
    frequent = (sizes.select(F.inline(F.arrays_zip("top", "top_n")))
                .orderBy(F.desc("top_n"), "top").limit(HOT_CONTEXTS).collect())
    per = np.zeros((1 << bits) + 1, np.int64)
    for r in rows:
        per[r.shard + 1] = r.size
    vocabulary = Vocabulary(words_at, np.cumsum(per), bits)
    hot = np.sort(vocabulary.ids(np.array([r.top for r in frequent], np.int64).view(np.uint64)))
    start = int(vocabulary.ids(np.array([START]))[0])
    shards = 4 * parts

    def count_pairs(it):
        sums = _Sums()

        def out():
            k, c = sums.merged()
            return pa.RecordBatch.from_arrays(
                [pa.array(_shard(k >> 32, k & 0xFFFFFFFF, hot, shards).astype(np.int32)), pa.array(k), pa.array(c)],
                ["shard", "key", "n"])

        for b in it:
            for _, _, data, off in tb.batches(b.column("_text")):
                row, h = _tokens(data, off)
                ids = vocabulary.ids(h)
                sums.add(*np.unique(_before(row, ids, start) << 32 | ids, return_counts=True))
                if sums.size > FLUSH:
                    yield out()
        if sums.parts:
            yield out()

    def write_pairs(it):
        for shard, (key, n) in _write_groups(it, ("key", "n")):
            ha.save(pairs_at, "key", shard, key)
            ha.save(pairs_at, "count", shard, n.astype(np.uint32))
            u, at = np.unique(key >> 32, return_index=True)
            sums = [np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n >= 3)]
            w, left = np.unique(key & 0xFFFFFFFF, return_counts=True)
            nil = lambda x: np.zeros(len(x), np.int64)
            few = [np.array([(n == k).sum()]) for k in (1, 2, 3, 4)]
            for ids, cols in ((u, [*sums, nil(u)]), (w, [*[nil(w)] * 4, left]), (np.array([-1]), [*few, nil([0])])):
                of = np.searchsorted(bounds, ids, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of.astype(np.int32)), *[pa.array(np.asarray(x, np.int64)) for x in (ids, *cols)]],
                    ["shard", *names])

    bounds = vocabulary.bases
    names = ["id", "total", "n1", "n2", "n3", "left"]
    pairs_at = scratch(spark, "lm-pairs")
    pairs = (texts.mapInArrow(count_pairs, "shard int, key long, n long").repartition(parts, "shard")
             .groupBy("shard", "key").agg(F.sum("n").alias("n")).sortWithinPartitions("shard", "key"))
    facts = stored(pairs.mapInArrow(write_pairs, "shard int, " + ", ".join(f"{x} long" for x in names)), "lm-facts")
    # n1 to n4 are in the rows with id -1
    high = facts.filter("id = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names[1:]]).first()

    def write_facts(it):
        for shard, cols in _write_groups(it, names):
            order = np.argsort(cols[0])
            size = int(bounds[shard + 1] - bounds[shard])
            at = cols[0][order] - bounds[shard]
            for name, col in zip(names[1:], cols[1:]):
                full = np.zeros(size, np.uint32 if name != "total" else np.uint64)
                full[at] = col[order]
                ha.save(words_at, name, shard, full)
            left = cols[5]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int((left == k).sum())]) for k in (1, 2, 3, 4)] + [pa.array([int(left.sum())]),
                                                                             pa.array([int((left >= 3).sum())])],
                ["c1", "c2", "c3", "c4", "kinds", "c3up"])

    by_id = facts.filter("id >= 0").repartition(parts, "shard", "id").groupBy("shard", "id").agg(
        *[F.sum(c).alias(c) for c in names[1:]])
    low = stored(by_id.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(
        write_facts, "c1 long, c2 long, c3 long, c4 long, kinds long, c3up long"), "lm-low")
    few = low.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in low.columns]).first()
    lows = _discounts([few.c1, few.c2, few.c3, few.c4])
    rest = (lows[0] * few.c1 + lows[1] * few.c2 + lows[2] * few.c3up) / few.kinds if few.kinds else 1.0
    return Model(vocabulary, pairs_at, shards, hot, start, _discounts([high.total, high.n1, high.n2, high.n3]),
                 (sum(r.tokens for r in rows), sum(r.words for r in rows), few.kinds, lows, rest))


def crc_split(doc_id, folds: int = 5, held: int = 1):
    """Whether a document is held out: crc32 of its id as text modulo ``folds`` is ``held``
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == held


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of every row with its tokens, known tokens, training tokens, the
    add-half unigram ``base_score`` and the model's ``score``, both log10.

    A null or empty text is one end token.  Unknown words get the uniform share of the
    lowest order.  Repeated rows score alike, each on its own; an empty table gives an
    empty result, and a model of no text gives every token 1.
    """
    def run(it):
        for b in it:
            for lo, hi, data, off in tb.batches(b.column("_text")):
                row, h = _tokens(data, off)
                n_tokens, known, base, full = model.score(row, h, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).slice(lo, hi - lo) for k in carry], pa.array(n_tokens), pa.array(known),
                     pa.array(np.full(hi - lo, model.train_tokens)), pa.array(base), pa.array(full)],
                    [*carry, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in carry]
    return docs.select(*[F.col(f"`{k}`") for k in carry], F.col("text").alias("_text")).mapInArrow(
        run, ", ".join([*kinds, "n_tokens long, n_known long, train_tokens long, base_score double, score double"]))
