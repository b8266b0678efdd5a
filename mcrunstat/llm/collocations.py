"""Phrase collocations from count streams in prefix and suffix order, merged in lockstep.

Words of a language get numbers; a word that no candidate can hold (fewer than ``least``
occurrences, and so for every phrase with it) has none and ends a phrase.  Each task counts
the windows of its texts (a word and the numbered words after it, two at most); Spark sums
them.  What reaches ``least`` is one stream of (first, second, third, count), where a word has
no second and a pair no third.  The stream is dealt by ranges of keys, once as it stands
and once by its reversed words, and sorted: every phrase then follows its first words (its
last words), so a single pass over neighbours gives left counts (right counts) and the
largest extension of each phrase.  A phrase whose extensions lie on several ranges is sent
to each of them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import n_partitions, scratch, stored
from mcrunstat.llm import hasharrays as ha

APART = np.zeros(256, bool)
APART[[0x20, 9, 10, 11, 12, 13, *b".,;:!?"]] = True
#: Bytes between two words that end a piece.
ENDS = APART.copy()
ENDS[[0x20, 9]] = False

FLUSH = 400_000
#: A pair is one long of two numbers; 0 stands for no word.
BITS = 31
SALTS = 64


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name and check of each word, two independent hashes; ``salt`` tells languages apart."""
    return tuple(tb.mix(tb.ranges(tb.prefix(tb.TABLES[k][data], k), start, end, k) ^ salt) for k in (1, 0))


def _salts(langs) -> np.ndarray:
    known = {x: xxhash.xxh64_intdigest(x.encode(), 12) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _words(texts, langs):
    """(first row, bytes, rows, starts, ends, names, checks, whether a piece ends before the word)
    of batches of rows, in lower case."""
    for lo, hi, data, off in tb.batches(texts):
        data = tb.LOWER[data]
        start, end = tb.words(data, off, APART)
        if not len(start):
            continue
        row = tb.rows_of(off, start)
        names, checks = _hashes(data, start, end, _salts(langs[lo:hi])[row])
        ends = np.concatenate([[0], np.cumsum(ENDS[data])])
        cut = np.ones(len(start), bool)
        cut[1:] = (ends[start[1:]] != ends[end[:-1]]) | (row[1:] != row[:-1])
        yield lo, data, row, start, end, names, checks, cut


def _summed(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """Rows (keys..., count) with equal keys summed, in the order of their keys."""
    cols = [np.concatenate(x) for x in zip(*parts)]
    order = np.lexsort(cols[-2::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in cols[:-1]))
    first = np.flatnonzero(new)
    return [c[first] for c in cols[:-1]] + [np.add.reduceat(cols[-1], first)]


class Numbers:
    """Numbers (from 1) of the words that candidates may hold: sorted arrays of names by the
    top bits with their checks, mapped by the workers; 0 for every other word."""

    def __init__(self, folder: str, bases: np.ndarray, bits: int):
        self.folder, self.bases, self.bits = folder, bases, bits

    def of(self, names: np.ndarray, checks: np.ndarray) -> np.ndarray:
        unique, first, back = np.unique(names, return_index=True, return_inverse=True)
        out, known = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.uint64)
        shard = (unique >> np.uint64(64 - self.bits)).astype(np.int64)
        edges = np.searchsorted(shard, np.arange((1 << self.bits) + 1))
        for s in np.unique(shard):
            part = slice(edges[s], edges[s + 1])
            at = ha.find(ha.load(self.folder, "name", int(s)), unique[part])
            hit = np.flatnonzero(at >= 0) + edges[s]
            if len(hit):
                at = at[at >= 0]
                out[hit], known[hit] = at + 1 + self.bases[s], ha.load(self.folder, "check", int(s))[at]
        return np.where(known[back] == checks, out[back], 0)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, f: every word of every language."""
    def out(held):
        names, checks, n = (np.concatenate([h[k] for h in held]) for k in range(3))
        order = np.lexsort((checks, names))
        names, checks, n = names[order], checks[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (checks[1:] != checks[:-1])]))
        langs, found = [x for h in held for x in h[3]], [x for h in held for x in h[4]]
        at = order[first].tolist()
        return pa.RecordBatch.from_arrays([pa.array([langs[k] for k in at]), pa.array([found[k] for k in at]),
                                           pa.array(np.add.reduceat(n, first))], ["lang", "word", "n"])

    def run(it):
        held, size = [], 0
        for b in it:
            langs = b.column("_lang").to_pylist()
            for lo, data, row, start, end, names, checks, _ in _words(b.column("_text"), langs):
                unique, first, back, n = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
                if (checks[first][back] != checks).any():  # two words of one name: each occurrence for itself
                    unique, first, n = names, np.arange(len(names)), np.ones(len(names), np.int64)
                raw = data.tobytes()
                held.append((unique, checks[first], n, [langs[lo + r] for r in row[first].tolist()],
                             [raw[a:z].decode() for a, z in zip(start[first].tolist(), end[first].tolist())]))
                size += len(unique)
                if size > FLUSH:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)
        tb.release()

    found = docs.mapInArrow(run, "lang string, word string, n long")
    return stored(found.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")


def number(words: DataFrame, least: int) -> tuple[DataFrame, Numbers]:
    """(id, lang, word, f) of the words with ``least`` occurrences, and the numbers for tasks."""
    spark = words.sparkSession
    parts = n_partitions(spark)
    bits = max(4, int(parts - 1).bit_length() + 1)
    folder = scratch(spark, "phrase-numbers")

    def hashed(b):
        for _, _, data, off in tb.batches(b.column("word"), 1 << 40):  # all rows at once
            return _hashes(data, off[:-1], off[1:], _salts(b.column("lang").to_pylist()))

    def name(it):
        for b in it:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in hashed(b)], ["name", "check"])

    def write(it):
        # a shard is one partition's run of rows: names of equal top bits, in order
        held, now = [], None

        def out():
            names, checks = (np.concatenate([h[k] for h in held]).view(np.uint64) for k in (0, 1))
            if (names[1:] == names[:-1]).any():
                raise ValueError("two frequent words share a 64-bit name: change the seed of the byte tables")
            ha.save(folder, "name", now, names)
            ha.save(folder, "check", now, checks)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(names)])], ["shard", "size"])

        for b in it:
            shard = np.asarray(b.column("shard"))
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if now is not None and shard[lo] != now:
                        yield out()
                        held = []
                    now = int(shard[lo])
                    held.append([np.asarray(b.column(c))[lo:hi] for c in ("name", "check")])
        if held:
            yield out()

    frequent = words.filter(F.col("f") >= least)
    shards = (frequent.mapInArrow(name, "name long, check long")
              .withColumn("shard", F.shiftrightunsigned("name", 64 - bits).cast("int")))
    unsigned = F.col("name").bitwiseXOR(F.lit(-(1 << 63)))
    sizes = stored(shards.repartition(parts, "shard")
                   .sortWithinPartitions("shard", unsigned).mapInArrow(write, "shard int, size long"), "phrase-sizes")
    per = np.zeros((1 << bits) + 1, np.int64)
    for r in sizes.collect():  # one row a shard
        per[r.shard + 1] = r.size
    bases = np.cumsum(per)
    if bases[-1] >= (1 << BITS) - 1:
        raise ValueError(f"{bases[-1]} frequent words; a number has {BITS} bits")
    numbers = Numbers(folder, bases, bits)

    def ids(it):
        # names are made anew: a second Python worker behind the first would stay with every task
        for b in it:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(numbers.of(*hashed(b))), *(b.column(c) for c in ("lang", "word", "f"))],
                                                 ["id", "lang", "word", "f"])

    numbered = stored(frequent.mapInArrow(ids, "id long, lang string, word string, f long"), "phrase-numbered")
    return numbered, numbers


def count_phrases(docs: DataFrame, numbers: Numbers, least: int) -> DataFrame:
    """(first, second, third, f) of the pairs and triples with ``least`` occurrences."""
    def run(it):
        def out(held):
            pair, third, n = _summed(held)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(third), pa.array(n)], ["pair", "third", "n"])

        held, size = [], 0
        for b in it:
            for *_, names, checks, cut in _words(b.column("_text"), b.column("_lang").to_pylist()):
                ids = numbers.of(names, checks)
                after = np.zeros(len(ids) + 2, np.int64)
                after[1:-2] = np.where(cut[1:], 0, ids[1:])  # the word after each, 0 over a piece's end
                second, third = after[1:-1], after[2:]
                third = np.where(second > 0, third, 0)
                keep = np.flatnonzero((ids > 0) & (second > 0))
                part = _summed([(ids[keep] << BITS | second[keep], third[keep], np.ones(len(keep), np.int64))]) if len(keep) else None
                if part:
                    held.append(part)
                    size += len(part[0])
                if size > FLUSH:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)
        tb.release()

    windows = stored(docs.mapInArrow(run, "pair long, third long, n long").groupBy("pair", "third").agg(F.sum("n").alias("f")),
                     "phrase-windows")
    # a pair's windows are spread by their third word; its partial sums meet
    pairs = windows.groupBy("pair").agg(F.sum("f").alias("f")).withColumn("third", F.lit(0).cast("long"))
    both = pairs.unionByName(windows.filter("third > 0")).filter(F.col("f") >= least)
    return both.select(F.shiftright("pair", BITS).alias("first"), F.col("pair").bitwiseAND(F.lit((1 << BITS) - 1)).alias("second"),
                       "third", "f")


def _merge(it):
    """A range's stream in key order: for every phrase the counts of its first word and of
    its first two, and for every pair the largest count of a triple that it begins."""
    word = pair = (0, 0, 0)  # the latest word and pair: their keys and count
    for b in it:
        a, s, t, f = (np.asarray(b.column(c)) for c in ("a", "b", "c", "f"))
        n = len(a)
        if not n:
            continue
        at = np.arange(n)
        one = np.maximum.accumulate(np.where(s == 0, at, -1))
        two = np.maximum.accumulate(np.where((s > 0) & (t == 0), at, -1))
        w = np.where(one >= 0, f[one], word[2])
        p = np.where(two >= 0, f[two], pair[2])
        whole = np.flatnonzero(s > 0)
        none = pa.nulls(len(whole), pa.int64())
        longer = t[whole] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[whole]), pa.array(s[whole]), pa.array(t[whole]), pa.array(f[whole]), pa.array(w[whole]),
             pa.array(np.where(longer, p[whole], 0)), none], ["a", "b", "c", "f", "one", "two", "longer"])
        triple = np.flatnonzero(t > 0)
        if len(triple):
            x, y = a[triple], s[triple]
            first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            none, zero = pa.nulls(len(first), pa.int64()), pa.array(np.zeros(len(first), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[first]), pa.array(y[first]), zero, none, none, none,
                 pa.array(np.maximum.reduceat(f[triple], first))], ["a", "b", "c", "f", "one", "two", "longer"])
        if one[-1] >= 0:
            word = (a[one[-1]], 0, f[one[-1]])
        if two[-1] >= 0:
            pair = (a[two[-1]], s[two[-1]], f[two[-1]])


def _in_order(stream: DataFrame, names: list[str], ranges: int) -> DataFrame:
    """``stream`` merged in the order of the columns ``names``: a, b, c (those columns), f,
    one, two (counts of the first word and of the first two), longer."""
    keyed = stream.select(*[F.col(n).alias(x) for n, x in zip(names, "abc")], "f")
    # the first key of each of ``ranges`` ranges of equally many rows: one row a range
    edges = sorted(tuple(r) for r in keyed.repartitionByRange(ranges, "a", "b", "c").groupBy(F.spark_partition_id().alias("p"))
                   .agg(F.min(F.struct("a", "b", "c")).alias("m")).select("m.*").collect())[1:]
    edge, edge_c = (np.array([e[0] << BITS | e[1] for e in edges], np.int64), np.array([e[2] for e in edges], np.int64))
    most = (1 << BITS) - 1

    def place(key, c):
        """Number of edges at or below each key."""
        low, high = np.searchsorted(edge, key, "left"), np.searchsorted(edge, key, "right")
        out = high.copy()
        split = np.flatnonzero(high > low)
        for lo, hi in {*zip(low[split].tolist(), high[split].tolist())}:
            own = split[(low[split] == lo)]
            out[own] = lo + np.searchsorted(edge_c[lo:hi], c[own], "right")
        return out

    def deal(it):
        for batch in it:
            a, b, c = (np.asarray(batch.column(x)) for x in "abc")
            begin = place(a << BITS | b, c)
            n = place(a << BITS | np.where(b == 0, most, b), np.where(c == 0, most, c)) - begin + 1
            at = np.repeat(np.arange(len(a)), n)
            own = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + begin[at]
            f = np.asarray(batch.column("f"))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *(pa.array(x[at]) for x in (a, b, c, f))],
                                             ["range", "a", "b", "c", "f"])

    keyed = keyed.mapInArrow(deal, "range int, a long, b long, c long, f long")
    return (keyed.repartition(ranges, "range").sortWithinPartitions("range", "a", "b", "c").select("a", "b", "c", "f")
            .mapInArrow(_merge, "a long, b long, c long, f long, one long, two long, longer long"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """The ``top`` collocations of two or three words of each language of ``docs`` (lang, text;
    other columns are not read): lang, rank, phrase, a, l, r, n, score.

    A null lang is ``und``, a null text empty; texts in lower case (A-Z) are cut into pieces
    at ``.,;:!?`` and line ends and into words at spaces and tabs.  A candidate occurs ``least`` times; its
    lowest-scoring cut counts, equal scores going to the earliest.  A candidate goes where a longer one with it
    inside has ``share`` percent of its occurrences.  Repeated rows count as often as they are
    there; ties go by count and then by phrase; an empty table gives no rows.  Products
    are decimals of 38 digits, exact for counts below 10^15.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("_lang"), F.col("text").alias("_text"))
    words = count_words(docs)
    numbered, numbers = number(words, least)
    phrases = count_phrases(docs, numbers, least)
    zero = F.lit(0).cast("long")
    stream = stored(phrases.unionByName(numbered.select(F.col("id").alias("first"), zero.alias("second"), zero.alias("third"), "f")),
                    "phrase-stream")
    ranges = n_partitions(spark)
    ahead = _in_order(stream, ["first", "second", "third"], ranges).select(
        F.col("a").alias("first"), F.col("b").alias("second"), F.col("c").alias("third"), "f",
        F.col("one").alias("left1"), F.col("two").alias("left2"), "longer")
    # reversed words: a pair (x, y) is keyed (y, x, 0), a triple (x, y, z) is (z, y, x)
    turned = stream.select(
        F.when(F.col("third") > 0, F.col("third")).when(F.col("second") > 0, F.col("second")).otherwise(F.col("first")).alias("z"),
        F.when(F.col("third") > 0, F.col("second")).when(F.col("second") > 0, F.col("first")).otherwise(zero).alias("y"),
        F.when(F.col("third") > 0, F.col("first")).otherwise(zero).alias("x"), "f")
    three = F.col("c") > 0
    back = _in_order(turned, ["z", "y", "x"], ranges).select(
        F.when(three, F.col("c")).otherwise(F.col("b")).alias("first"),
        F.when(three, F.col("b")).otherwise(F.col("a")).alias("second"),
        F.when(three, F.col("a")).otherwise(zero).alias("third"),
        "f", F.col("one").alias("right1"), F.col("two").alias("right2"), "longer")
    key = ["first", "second", "third"]
    found = (ahead.unionByName(back, allowMissingColumns=True).groupBy(*key)
             .agg(*[F.max(c).alias(c) for c in ("f", "left1", "left2", "right1", "right2", "longer")]))
    # a cut after the first word: its count and that of the rest; after the second: the pair's and the last word's
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    product = (wide("f") * wide("f")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    scores = {"s1": ("l1", "r1"), "s2": ("l2", "r2")}
    pair = F.col("third") == 0
    found = (found.filter(~(pair & (F.lit(100) * F.coalesce("longer", zero) >= F.lit(share) * F.col("f"))))
             .withColumns({"l1": F.col("left1"), "r1": F.when(pair, F.col("right1")).otherwise(F.col("right2")),
                           "l2": F.when(~pair, F.col("left2")), "r2": F.when(~pair, F.col("right1")), "_a": product})
             .withColumns({s: F.call_function("div", F.col("_a"), (wide(x) * wide(y)).cast("decimal(32,0)"))
                           for s, (x, y) in scores.items()})
             .withColumn("_second", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
             .select(*key, F.col("f").alias("a"), *[F.when(F.col("_second"), F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(o)
                                                    for c, o in (("l", "l"), ("r", "r"), ("s", "score"))]))
    named = numbered.select("id", "word", F.col("lang").alias("_of"))
    for k in key:
        word = named.select(F.col("id").alias(k), F.col("word").alias(f"_{k}"), *([F.col("_of").alias("lang")] if k == "first" else []))
        found = found.join(word, k, "left")
    found = stored(found.select("lang", F.concat_ws(" ", "_first", "_second", "_third").alias("phrase"), "a", "l", "r", "score"),
                   "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = (found.withColumn("_salt", salt)
            .withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_at") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top))
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
