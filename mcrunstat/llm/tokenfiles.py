"""Token-ID files: canonical length-limited Huffman codes in independent blocks.

The files of a set are a ``codebook`` (symbol, code length) and ``blocks``.  A block
holds whole documents of about 2**16 ids: its bits, the bit offset of every 512th id,
the documents' ids and lengths, its shard and its place.  Shards are ranges of doc_id in
ascending order and blocks follow each other inside a shard, so any block decodes alone
and knows where it starts.  Both tables are Parquet files: Spark's committer writes them
whole or not at all, and its readers deal them out again.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import n_partitions, stored
from mcrunstat.llm.hasharrays import find
from mcrunstat.llm.huffman import Code, code_lengths

BLOCK_IDS, STEP, WIDTH = 1 << 16, 512, 16
CACHED_WORDS = 600_000
#: Between words that are encoded together; a special token of its own.
_MARK = "<|startoftext|>"
_TAIL, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_TAIL[[*b".,!?:;*$&%#"]] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _bytes_as_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes as themselves, the others as the letters
    after the 256th in turn."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


_LETTERS = _bytes_as_letters()


def _splits_at_space(tokenizer) -> bool:
    """Whether a text's ids are those of its words in turn, words cut between letters and
    punctuation and in lower case, as ``_Encoder`` assumes."""
    shape = json.loads(tokenizer.to_str())
    steps = [[s["type"] for s in (shape[k] or {}).get({"normalizer": "normalizers", "pre_tokenizer": "pretokenizers"}[k], [])]
             for k in ("normalizer", "pre_tokenizer")]
    if steps != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] or shape["post_processor"] is not None:
        return False
    split, level = shape["pre_tokenizer"]["pretokenizers"]
    return (shape["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and split["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]
            and shape["model"]["type"] == "BPE" and not shape["model"]["dropout"]
            and all(t["special"] and "<|" in t["content"] for t in shape["added_tokens"]))


class _Encoder:
    """Ids of whole texts.  The tokenizer splits at white space before anything else, so a
    text's ids are those of its words in turn; each distinct word is encoded once and
    remembered by its 64-bit hash, up to a bound: a large sorted table, and a small one
    of the newest words that joins it when it has grown.  At the bound, words that no later
    batch has asked for again are forgotten.  A tokenizer of another kind gets whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _splits_at_space(self.tokenizer)
        self.mark = self.tokenizer.token_to_id(_MARK)
        self._clear()

    def _clear(self) -> None:
        self.levels = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2  # sorted hashes, their entries
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.again = np.zeros(1 << 20, bool)  # of an entry: asked for again

    def _forget(self) -> None:
        h, at = (np.concatenate(x) for x in zip(*self.levels))
        kept = self.again[at]
        h, (ids, size) = h[kept], self._take(at[kept])
        self._clear()
        if len(h) <= CACHED_WORDS // 2:
            self._insert(h, ids, size)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        # a lower-case Latin word is one piece of the byte-level alphabet, which the model takes as it is
        model, out, rest = self.tokenizer.model, [], []
        for k, w in enumerate(words):
            if w.isalpha() and w.islower() and (w.isascii() or (max(w) < "\u0250" and is_normalized("NFC", w))):
                if not w.isascii():
                    w = w.encode().decode("latin-1").translate(_LETTERS)
                out.append([t.id for t in model.tokenize(w)])
            else:
                out.append(None)
                rest.append(k)
        for k, own in zip(rest, self._marked([words[k] for k in rest])):
            out[k] = own
        return np.fromiter(chain.from_iterable(out), np.uint32), np.fromiter(map(len, out), np.int64, len(out))

    def _marked(self, words: list[str]) -> list:
        """Ids of any words, many to a text with a special token between them."""
        odd = [k for k, w in enumerate(words) if self.mark is None or "<|" in w]
        out: list = [None] * len(words)
        for k, e in zip(odd, self.tokenizer.encode_batch_fast([words[k] for k in odd], add_special_tokens=False)):
            out[k] = e.ids
        plain = [k for k in range(len(words)) if out[k] is None]
        groups = [plain[k: k + 32] for k in range(0, len(plain), 32)]
        for lo in range(0, len(groups), 512):
            texts = [_MARK.join(words[k] for k in g) for g in groups[lo: lo + 512]]
            for g, e in zip(groups[lo: lo + 512], self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array([*e.ids, self.mark], np.uint32)
                ends = np.flatnonzero(ids == self.mark)
                for k, a, b in zip(g, [0, *(ends + 1)], ends):
                    out[k] = ids[a:b].tolist()
        return out

    def _learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Enter the words at ``start`` to ``end`` of ``data``.

        The tokenizer lower-cases, and cuts between a letter or digit and punctuation; so an
        ASCII word is looked up in lower case, and without the punctuation at its end."""
        size = end - start
        stop = np.cumsum(size)
        start = stop - size
        raw = data[np.arange(stop[-1]) + np.repeat(end - stop, size)]
        special = np.zeros(len(raw) + 1, np.int64)
        special[1:-1] = np.cumsum((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
        special[-1] = special[-2]
        odd = special[stop - 1] > special[start]
        cut, at = stop.copy(), np.arange(len(start))
        while len(at):
            at = at[cut[at] > start[at]]
            at = at[_TAIL[raw[cut[at] - 1]]]
            cut[at] -= 1
        last = raw[np.maximum(cut, 1) - 1]
        apart = (cut > start) & ~odd & _ALNUM[last]
        for k in np.flatnonzero((cut > start) & ~odd & (last >= 0x80)).tolist():
            apart[k] = raw[start[k]: cut[k]].tobytes().decode()[-1].isalnum()
        cut = np.where(apart, cut, stop)
        wide = np.concatenate([[0], np.cumsum(raw >= 0x80)])
        lower = (wide[cut] == wide[start]) & ~odd
        own = np.where(np.repeat(lower, size), tb.LOWER[raw], raw)
        p = tb.prefix(tb.TABLES[0][own])
        tails = np.flatnonzero(cut < stop)
        lo, hi = np.concatenate([start, cut[tails]]), np.concatenate([cut, stop[tails]])
        parts, first = np.unique(tb.ranges(p, lo, hi), return_index=True)
        known = self._places(parts)
        self.again[known[known >= 0]] = True
        new = np.flatnonzero(known < 0)
        if len(new):
            text, first = own.tobytes(), first[new]
            self._insert(parts[new], *self._ids([text[a:b].decode() for a, b in zip(lo[first].tolist(), hi[first].tolist())]))
        place = self._places(tb.ranges(p, lo, hi))
        pair = np.full((len(start), 2), -1, np.int64)
        pair[:, 0], pair[tails, 1] = place[: len(start)], place[len(start):]
        rest = np.flatnonzero(self._places(hashes) < 0)
        if len(rest):
            ids, size = self._take(pair[rest].reshape(-1))
            self._insert(hashes[rest], ids, size.reshape(-1, 2).sum(1))

    def _take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries one after another, and each entry's number (-1: none)."""
        size = np.where(at >= 0, self.flat[at], 0).astype(np.int64)
        total = np.cumsum(size)
        if not len(at):
            return np.zeros(0, np.uint32), size
        return self.flat[np.arange(total[-1]) + np.repeat(at + 1 - (total - size), size)], size

    def _insert(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        need = self.used + len(ids) + len(sizes)
        if need > len(self.flat):
            more = max(need, len(self.flat))
            self.flat = np.concatenate([self.flat, np.zeros(more, np.uint32)])
            self.again = np.concatenate([self.again, np.zeros(more, bool)])
        # a word's entry: the number of its ids, then the ids
        at = np.cumsum(sizes + 1) - (sizes + 1) + self.used
        entry = np.ones(len(ids) + len(sizes), bool)
        entry[at - self.used] = False
        block = self.flat[self.used: need]
        block[~entry], block[entry] = sizes, ids
        self.used = need
        new_h, new_at = np.concatenate([self.levels[1][0], hashes]), np.concatenate([self.levels[1][1], at])
        order = np.argsort(new_h)
        self.levels[1] = (new_h[order], new_at[order])
        if len(new_h) > 1 << 18:
            h, a = (np.concatenate([x, y]) for x, y in zip(*self.levels))
            order = np.argsort(h)
            self.levels = [(h[order], a[order]), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        for h, at in self.levels:
            k = find(h, hashes)
            hit = k >= 0
            out[hit] = at[k[hit]]
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows of a byte batch, and the number of each row's."""
        rows = len(off) - 1
        if not self.by_word:
            raw = data.tobytes()
            found = self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())],
                                                     add_special_tokens=False)
            return (np.concatenate([np.array(e.ids, np.uint32) for e in found]),
                    np.array([len(e.ids) for e in found], np.int64))
        start, end = tb.words(data, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        h = tb.ranges(tb.prefix(tb.TABLES[0][data]), start, end)
        unique, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.levels[0][0]) > CACHED_WORDS:
            self._forget()
        place = self._places(unique)
        self.again[place[place >= 0]] = True
        new = np.flatnonzero(place < 0)
        if len(new):
            self._learn(unique[new], data, start[first[new]], end[first[new]])
            place[new] = self._places(unique[new])
        at = place[back]
        ids, size = self._take(at)
        return ids, np.bincount(tb.rows_of(off, start), size, rows).astype(np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id") -> DataFrame:
    """``key``, ``n`` and packed ids of each whole text with ``end_id`` after it, and rows
    with a null pack that hold each task's counts by id (``seen``, ``times``)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(it):
        encoder, pack = _encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        counts = np.zeros(1 << 16, np.int64)
        schema = None
        for b in tb.released(it):
            schema = b.schema.field(0).type
            for lo, hi, data, off in tb.batches(b.column("_text")):
                ids, n = encoder.encode(data, off)
                # the end id after each row's ids
                last = np.cumsum(n + 1) - 1
                every = np.full(len(ids) + len(n), end_id, np.uint32)
                inner = np.ones(len(every), bool)
                inner[last] = False
                every[inner] = ids
                if every.max() >= len(counts):
                    counts = np.pad(counts, (0, 1 << int(every.max()).bit_length()))
                counts[: (top := int(every.max()) + 1)] += np.bincount(every, minlength=top)
                small = [pack.compress(_planes(every[a:z + 1])) for a, z in zip(last - n, last)]
                none = pa.nulls(hi - lo, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n + 1), pa.array(small, pa.binary()), none, none],
                    [key, "n", "packed", "seen", "times"])
        tb.release()  # the worker lives on, with the tokenizer and its words
        if schema is not None:
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([seen], pa.list_(pa.int64())), pa.array([counts[seen]], pa.list_(pa.int64()))],
                [key, "n", "packed", "seen", "times"])

    return docs.select(key, F.col("text").alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, n long, packed binary, seen array<long>, times array<long>")


def _planes(ids: np.ndarray) -> bytes:
    """The bytes of 32-bit ids by place, which pack better."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", limit: int = WIDTH) -> None:
    """Encode ``docs`` (key, text) into files under ``folder``, ascending by key.

    A null or empty text is its end id only; null keys come first; repeated rows are
    written each on its own, equal keys by their ids; an empty table gives files without
    blocks.  The code is made from the counts of all ids: one count per distinct id
    reaches the driver, which the vocabulary bounds.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    ids = stored(tokenize(docs, tokenizer, end_id, key), "token-ids")
    counted = (ids.filter("packed is null").select(F.inline(F.arrays_zip("seen", "times")))
               .groupBy("seen").agg(F.sum("times").alias("times")).collect())
    counts = np.zeros(max([r.seen for r in counted], default=0) + 1, np.int64)
    for r in counted:
        counts[r.seen] = r.times
    lengths = code_lengths(counts, max(limit, int(len(counted)).bit_length()))
    spark.createDataFrame([(int(s), int(lengths[s])) for s in np.flatnonzero(lengths)],
                          "symbol int, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    code = Code(lengths)

    def run(it):
        unpack = zstandard.ZstdDecompressor()
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        keys, sizes, parts, held, kind_ = [], [], [], 0, None

        def out():
            data, points = code.pack(np.concatenate(parts), STEP)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([keys], pa.list_(kind_)), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([points.astype("<u4").tobytes()], pa.binary()), pa.array([data], pa.binary())],
                ["shard", "block", "first", "n", "keys", "sizes", "checkpoints", "bits"])

        for b in tb.released(it):
            kind_ = b.schema.field(0).type
            for k, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                values = _from_planes(unpack.decompress(packed))
                keys.append(k)
                sizes.append(len(values))
                parts.append(values)
                held += len(values)
                if held >= BLOCK_IDS:
                    yield out()
                    block, first = block + 1, first + held
                    keys, sizes, parts, held = [], [], [], 0
        if keys:
            yield out()

    (ids.filter("packed is not null").select(key, "packed")
     .repartitionByRange(n_partitions(spark), key, F.xxhash64("packed")).sortWithinPartitions(key, "packed")
     .mapInArrow(run, f"shard int, block int, first long, n long, keys array<{kind}>, sizes array<long>, "
                      "checkpoints binary, bits binary")
     .write.parquet(f"{folder}/blocks"))


def read(spark: SparkSession, folder: str, key: str = "doc_id", values: bool = True) -> DataFrame:
    """Each document of the files: key, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` and, if asked for, the ``ids``."""
    lengths = {r.symbol: r.length for r in spark.read.parquet(f"{folder}/codebook").collect()}
    table = np.zeros(max(lengths, default=0) + 1, np.uint8)
    for s, n in lengths.items():
        table[s] = n
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    before, starts = 0, {}
    for r in blocks.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect():  # a row a shard
        starts[r.shard], before = before, before + r.n

    def run(it):
        code = Code(table)
        for b in tb.released(it):
            for lo in range(0, b.num_rows, 16):
                part = b.slice(lo, 16).to_pydict()
                ids = code.unpack([(bits, np.frombuffer(points, "<u4"), n) for bits, points, n in zip(
                    part["bits"], part["checkpoints"], part["n"])], STEP)
                out = []
                for shard, first, keys, sizes, block in zip(part["shard"], part["first"], part["keys"], part["sizes"], ids):
                    block = block.astype("<u4")
                    at = 0
                    for k, size in zip(keys, sizes):
                        own = block[at: at + size]
                        out.append((k, starts[shard] + first + at, size, zlib.crc32(own.tobytes()), own)[: 5 if values else 4])
                        at += size
                types = [b.schema.field("keys").type.value_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.uint32())]
                cols = [pa.array(x, t) for x, t in zip(zip(*out), types)]
                if values:
                    cols[4] = cols[4].cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(cols, [key, "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return blocks.mapInArrow(run, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long"
                             + ", ids array<long>" * values)
