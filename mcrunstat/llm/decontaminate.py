"""Benchmark decontamination: test phrases searched in an FM-index of each shard.

A shard is a run of documents of about ``shard_bytes`` in a task.  Its words become ids
of the phrases' vocabulary; any other word ends a run, and runs shorter than the
shortest phrase cannot hold one and stay out of the index.  All phrases are searched
backwards at once, the occurrences are located by sampled suffixes and merged into
removal spans.  Documents are not shuffled.

The phrases travel to every task, so the benchmark's size is checked against
``max_bytes`` first (an error beyond it: search such a benchmark in blocks of items).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.fmindex import FMIndex
from mcrunstat.llm.hasharrays import find

#: Bytes outside words: ASCII but digits and letters (upper case counts as its lower case).
APART = np.ones(256, bool)
APART[48:58] = APART[65:91] = APART[97:123] = APART[128:] = False


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, end = tb.words(data, off, APART)
    p = tb.prefix(tb.TABLES[0][tb.LOWER[data]]) if len(data) else np.zeros(1, np.uint64)
    return start, end, tb.ranges(p, start, end)


@dataclass
class Phrases:
    """Distinct phrases as rows of vocabulary ids (right-aligned, 0 before), with items."""

    vocabulary: np.ndarray
    ids: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def phrases(benchmark: DataFrame, window: int = 10, max_bytes: int = 256 << 20) -> Phrases:
    """All windows of ``window`` words of each item; a shorter item with words is one.
    Items without words have none; a null id is listed as ``null``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"benchmark of {size} bytes: search it in blocks of at most {max_bytes}")
    rows = items.collect()
    found: dict[tuple, set[str]] = defaultdict(set)
    for _, _, data, off in tb.batches(pa.array([r.text for r in rows], pa.string()), 1 << 62):
        start, _, h = word_hashes(data, off)
        edges = np.searchsorted(start, off)
        for r, lo, hi in zip(rows, edges, edges[1:]):
            for k in range(lo, max(lo + 1, hi - window + 1) if hi > lo else lo):
                found[tuple(h[k: min(k + window, hi)].tolist())].add(r.item)
    vocabulary = np.unique(np.array([w for p in found for w in p], np.uint64))
    ids = np.zeros((len(found), window), np.int64)
    lengths = np.array([len(p) for p in found], np.int64)
    for k, p in enumerate(found):
        ids[k, window - len(p):] = 1 + np.searchsorted(vocabulary, np.array(p, np.uint64))
    return Phrases(vocabulary, ids, lengths, [sorted(x) for x in found.values()])


def occurrences(symbols: np.ndarray, edges: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word position) of every occurrence in words given as ids (0: not in the
    vocabulary); ``edges`` are the first words of the documents."""
    none = np.zeros(0, np.int64)
    if not len(symbols) or not len(p.lengths):
        return none, none
    # runs of known words inside one document, long enough for the shortest phrase
    new = np.ones(len(symbols) + 1, bool)
    new[1:-1] = (symbols[1:] == 0) | (symbols[:-1] == 0)
    new[edges] = True
    starts = np.flatnonzero(new[:-1])
    lengths = np.diff(np.append(starts, len(symbols)))
    runs = (symbols[starts] > 0) & (lengths >= p.lengths.min())
    starts, lengths = starts[runs], lengths[runs]
    if not len(starts):
        return none, none
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(begin[-1], np.int64)
    source = np.zeros(begin[-1], np.int64)
    inner = np.ones(begin[-1], bool)
    inner[begin[1:] - 1] = False
    within = np.flatnonzero(inner)
    run = np.searchsorted(begin, within, "right") - 1
    source[within] = starts[run] + within - begin[run]
    text[within] = symbols[source[within]]
    index = FMIndex(text, len(p.vocabulary))
    lo, hi = index.search(p.ids, p.lengths)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return which, source[index.locate(rows)]


def _items(which: np.ndarray, row: np.ndarray, p: Phrases) -> dict[int, set[str]]:
    out: dict[int, set[str]] = defaultdict(set)
    for r, w in np.unique(np.stack([row, which], 1), axis=0) if len(row) else ():
        out[int(r)].update(p.items[w])
    return out


def search(docs: DataFrame, p: Phrases, carry: tuple[str, ...] = ("doc_id",), shard_bytes: int = tb.CHUNK_BYTES,
           with_text: bool = False) -> DataFrame:
    """``carry`` columns of every document with ``n_words``, ``n_hit``, ``items`` (ids as
    text, sorted), ``span_start`` / ``span_end`` (byte ranges of maximal runs of hit words)
    and, if asked for, ``kept_text`` (the text without these ranges).

    A null or empty text has no words and no hits; repeated rows are searched each on its
    own; an empty table gives an empty result; an empty benchmark hits nothing.
    """
    def run(it):
        for b in tb.released(it):
            for lo, hi, data, off in tb.batches(b.column("_text"), shard_bytes):
                n = hi - lo
                start, end, h = word_hashes(data, off)
                row = tb.rows_of(off, start)
                edges = np.searchsorted(row, np.arange(n))
                which, at = occurrences(find(p.vocabulary, h) + 1, edges[edges < len(h)], p)
                cover = np.zeros(len(h) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + p.lengths[which], -1)
                hit = np.cumsum(cover)[:-1] > 0
                n_words, n_hit = np.bincount(row, minlength=n), np.bincount(row[hit], minlength=n)
                items = _items(which, row[at], p)
                # spans: runs of hit words of one document
                k = np.flatnonzero(hit)
                joined = (np.diff(k) == 1) & (row[k][1:] == row[k][:-1]) if len(k) else np.zeros(0, bool)
                first = k[np.concatenate([[True], ~joined])] if len(k) else k
                final = k[np.concatenate([~joined, [True]])] if len(k) else k
                of = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=n))]).astype(np.int32)
                begins, ends = start[first] - off[row[first]], end[final] - off[row[first]]
                cols = [*[b.column(c).slice(lo, n) for c in carry], pa.array(n_words), pa.array(n_hit),
                        pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                        pa.ListArray.from_arrays(pa.array(of), pa.array(begins)),
                        pa.ListArray.from_arrays(pa.array(of), pa.array(ends))]
                if with_text:
                    cols.append(pa.array([_without(bytes(data[off[i]: off[i + 1]]), begins[of[i]: of[i + 1]],
                                                   ends[of[i]: of[i + 1]]) if of[i + 1] > of[i] else t
                                          for i, t in enumerate(b.column("_text").slice(lo, n).to_pylist())], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    cols, [*carry, "n_words", "n_hit", "items", "span_start", "span_end"] + ["kept_text"] * with_text)

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in carry]
    return docs.select(*[F.col(f"`{k}`") for k in carry], F.col("text").alias("_text")).mapInArrow(run, ", ".join(
        [*kinds, "n_words long, n_hit long, items array<string>, span_start array<long>, span_end array<long>"]
        + ["kept_text string"] * with_text))


def _without(text: bytes, begins: np.ndarray, ends: np.ndarray) -> str:
    keep = [text[a:b] for a, b in zip([0, *ends], [*begins, len(text)])]
    return b"".join(keep).decode()


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``search``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle(window: int = 10) -> str:
    """DuckDB SQL of ``digest`` over ``documents`` and ``benchmark``: every window as text."""
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
        b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM benchmark),
        p AS (SELECT DISTINCT item, least(len(w), {window}) AS n,
                     array_to_string(w[i : i + least(len(w), {window}) - 1], ' ') AS g
              FROM b, range(1, greatest(len(w) - {window - 1}, 1) + 1) t(i) WHERE len(w) > 0),
        dn AS (SELECT d.r, d.w, s.n FROM d, (SELECT DISTINCT n FROM p) s WHERE len(d.w) >= s.n),
        x AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM dn, range(1, len(w) - n + 2) t(i)),
        o AS (SELECT x.r, x.i, x.n, p.item FROM x JOIN p ON x.n = p.n AND x.g = p.g),
        h AS (SELECT r, count(DISTINCT k) AS n_hit FROM o, range(i, i + n) t(k) GROUP BY r),
        its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN its USING (r)
    """
