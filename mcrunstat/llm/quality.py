"""Quality rules: boosted trees over document statistics, with monotonic constraints.

The statistics are taken in tasks from whole texts (``textbytes``).  The trees are fitted
on the driver from a bounded, hash-ordered sample of labelled documents and travel to
the tasks as flat node arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm import boosting
from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The symbols of the contract.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = np.isin(np.arange(256), np.arange(65, 91))
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
LETTER = np.isin(np.arange(256) | 32, np.arange(97, 123)) | (np.arange(256) >= 128)
PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b".,;:!?\"'()-", np.uint8))

#: Features of the trees with their constraint: -1 where more can only lower the quality.
FEATURES = (("log_words", 0), ("mean_word_chars", 0), ("symbols_per_char", -1), ("dup_line_share", -1),
            ("repeat_word_share", -1), ("upper_share", -1), ("digit_share", -1), ("letter_share", 0),
            ("punctuation_share", 0), ("words_per_line", 0), ("distinct_word_share", 0))


def _repeated(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items (row, hash): whether it equals an earlier one, and whether it has any equal."""
    key = tb.mix(h + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, twin = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    twin[order[1:]] = same
    twin[order[:-1]] |= same
    return later, twin


def counts(data: np.ndarray, off: np.ndarray, window: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The integer counts of the contract and the features of each row of a byte batch."""
    n = len(off) - 1
    per = lambda at: np.bincount(tb.rows_of(off, at), minlength=n)
    start, end = tb.words(data, off)
    row = tb.rows_of(off, start)
    n_words = np.bincount(row, minlength=n)
    text = ~tb.SPACE[data] & (data & 0xC0 != 0x80)
    total = np.concatenate([[0], np.cumsum(text)])
    word_chars = total[off[1:]] - total[off[:-1]]
    symbols = per(np.flatnonzero(SYMBOLS[data]))
    shares = [per(np.flatnonzero(m[data])) for m in (UPPER, DIGIT, LETTER, PUNCTUATION)]
    # lines: from a row's start or a line feed to the next
    p = tb.prefix(tb.TABLES[0][data]) if len(data) else np.zeros(1, np.uint64)
    feeds = np.flatnonzero(data == 10)
    line_at = np.concatenate([off[:-1], feeds + 1])
    line_row = np.concatenate([np.arange(n), tb.rows_of(off, feeds)])
    order = np.lexsort((line_at, line_row))
    line_at, line_row = line_at[order], line_row[order]
    line_end = np.empty_like(line_at)
    line_end[:-1] = np.where(line_row[1:] == line_row[:-1], line_at[1:] - 1, off[1:][line_row[:-1]])
    line_end[-1:] = off[-1]
    with_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_at)
    line_at, line_end, line_row = line_at[with_word], line_end[with_word], line_row[with_word]
    later, _ = _repeated(line_row, tb.ranges(p, line_at, line_end))
    dup_lines = np.bincount(line_row[later], minlength=n)
    n_lines = np.bincount(line_row, minlength=n)
    # word windows found twice or more in the row
    h = tb.ranges(p, start, end)
    repeat = np.zeros(n, np.int64)
    if len(h) >= window:
        full = np.flatnonzero(row[window - 1:] == row[: len(row) - window + 1])
        _, twin = _repeated(row[full], tb.ranges(tb.prefix(h), full, full + window))
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, full[twin], 1)
        np.add.at(cover, full[twin] + window, -1)
        repeat = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=n)
    seen, _ = _repeated(row, h)
    distinct = n_words - np.bincount(row[seen], minlength=n)
    some = lambda a, b: a / np.maximum(b, 1)
    x = np.stack([np.log1p(n_words), some(word_chars, n_words), some(symbols, word_chars), some(dup_lines, n_lines),
                  some(repeat, n_words), *[some(s, word_chars) for s in shares], some(n_words, n_lines),
                  some(distinct, n_words)], 1).astype(np.float64)
    return np.stack([n_words, word_chars, symbols, dup_lines, repeat], 1).astype(np.int64), x


def rules(c: np.ndarray, least_words: int = 20, most_repeat: int = 30) -> np.ndarray:
    """The base rules: too few words, or too large a share of repeated windows."""
    return (c[:, 0] < least_words) | (100 * c[:, 4] > most_repeat * c[:, 0])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the counts and the feature vector of every whole text."""
    def run(it):
        for b in tb.released(it):
            for lo, hi, data, off in tb.batches(b.column("text")):
                c, x = counts(data, off)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), *[pa.array(c[:, i]) for i in range(len(COUNTS))],
                     pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", *COUNTS, "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, max_train: int = 10_000, **options) -> boosting.Trees:
    """Trees for label ``quality`` (1 good) from at most ``max_train`` labelled documents,
    those with the smallest hash of their id.  Null labels or ids do not train; without
    usable labels the trees are a constant."""
    picked = (labels.filter("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    sample = statistics(docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi"))
    rows = (stored(sample, "quality-sample").join(picked, "doc_id").dropDuplicates(["doc_id"])
            .orderBy("doc_id").select("x", "quality").collect())
    x = np.array([r.x for r in rows], np.float64).reshape(-1, len(FEATURES))
    y = np.array([float(r.quality > 0) for r in rows])
    return boosting.fit(x, y, np.array([s for _, s in FEATURES]), **options)


def judge(docs: DataFrame, model: boosting.Trees, threshold: float = 0.5, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every document's counts, ``base_failed``, the model's ``probability`` of good
    quality and ``kept``.

    A null or empty text has no words, so it fails the base rules.  Repeated rows are
    judged alike, each on its own; an empty table gives an empty result; other columns
    of the input take no part unless named in ``carry``.
    """
    def run(it):
        for b in tb.released(it):
            text = b.column("_text")
            for lo, hi, data, off in tb.batches(text):
                c, x = counts(data, off)
                p, failed = model.probabilities(x), rules(c)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).slice(lo, hi - lo) for k in carry], *[pa.array(c[:, i]) for i in range(len(COUNTS))],
                     pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)],
                    [*carry, *COUNTS, "base_failed", "kept", "probability"])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in carry]
    return docs.select(*[F.col(f"`{k}`") for k in carry], F.col("text").alias("_text")).mapInArrow(
        run, ", ".join([*kinds, *[f"{c} long" for c in COUNTS], "base_failed boolean", "kept boolean", "probability double"]))
