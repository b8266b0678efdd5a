"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments.  If two differ in at most r bits over m segments,
they differ in at most r // m bits in one of the first segments, or in fewer in one of
the others; so each fingerprint looks up the small Hamming balls around its segments in
a table of all fingerprints by segment, and every match is verified on all 64 bits.

Equal fingerprints are one row.  A table entry with more than ``most`` fingerprints
would make pairs by the square of its size; fingerprints that meet there are linked
through centres instead: two fingerprints are within r bits exactly if some 64-bit word
is within half of r of both, so each is listed under the words of its ball of that
radius and linked to the least fingerprint of the word.  That is linear, and complete.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm import textbytes as tb
from mcrunstat.llm.common import stored
from mcrunstat.llm.components import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the whole text; 0 without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(stops), BLOCK):
        part = np.array([h(joined[a:b], 42) for a, b in zip(starts[lo: lo + BLOCK], stops[lo: lo + BLOCK])], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``fp`` (the 64 bits as a long); null text counts as empty."""
    def run(it):
        for b in tb.released(it):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("_text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in carry], pa.array(fps.view(np.int64))], [*carry, "fp"])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in carry]
    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text")).mapInArrow(
        run, ", ".join([*kinds, "fp long"]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(low: int, width: int, radius: int) -> list[int]:
    """All words with up to ``radius`` bits set among bits low..low+width."""
    return [sum(1 << b for b in bits) for k in range(radius + 1)
            for bits in combinations(range(low, low + width), k)]


def _flipped(field: Column, flips: list[int]) -> Column:
    return F.transform(F.lit(flips).cast("array<bigint>"), lambda x: field.bitwiseXOR(x))


def segments(bits: int, m: int, distance: int) -> list[tuple[int, int, int]]:
    """(lowest bit, width, ball radius) of the segments that have to be looked up."""
    radius, rest = divmod(distance, m)
    out, low = [], 0
    for k in range(m):
        width = bits // m + (k < bits % m)
        r = radius if k <= rest else radius - 1
        if r >= 0:
            out.append((low, width, r))
        low += width
    return out


def links(fps: DataFrame, distance: int = 4, m: int | None = None, most: int = 2000) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp``, enough to connect all that are
    within ``distance`` bits of each other; every link given is one.

    ``m`` segments; by default 3, and 2 beyond 2**27 fingerprints, where longer segments
    keep the table's entries short.  The links are the same for every m and ``most``.
    """
    if m is None:
        m = 3 if fps.count() <= 1 << 27 else 2
    parts = segments(64, m, distance)

    def keys(radius_too: bool):
        each = []
        for k, (low, width, radius) in enumerate(parts):
            field = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(k << 58))
            flips = _masks(0, width, radius if radius_too else 0)
            each.append(_flipped(field, flips))
        return F.explode(F.concat(*each)).alias("key")

    entry = fps.select(F.col("fp").alias("v"), keys(False))
    probe = fps.select(F.col("fp").alias("u"), keys(True))
    hot = stored(entry.groupBy("key").count().filter(F.col("count") > most).select("key"), "simhash-hot")
    some_hot = not hot.isEmpty()
    if some_hot:
        by_centre = _through_centres(
            probe.join(hot, "key", "left_semi").select(F.col("u").alias("fp")).distinct(), distance)
        probe = probe.join(hot, "key", "left_anti")
    near = probe.join(entry, "key").filter(
        (F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)).select("u", "v")
    return near.unionByName(by_centre) if some_hot else near


def _through_centres(fps: DataFrame, distance: int) -> DataFrame:
    """Links of the given fingerprints through shared centres (see the module)."""
    flip = F.col("flip")
    listed = (fps.select("fp", F.explode(F.lit([_signed(x) for x in _masks(0, 64, (distance + 1) // 2)])).alias("flip"))
              .select("fp", F.col("fp").bitwiseXOR(flip).alias("centre"), (F.bit_count(flip) <= distance // 2).alias("near")))
    least = listed.filter("near").groupBy("centre").agg(F.min("fp").alias("v"))
    return listed.join(least, "centre").filter("fp != v").select(F.col("fp").alias("u"), "v").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id",
                    most: int = 2000) -> DataFrame:
    """Every row's ``key``, ``fp`` and ``component_id``: the smallest key reachable over
    links of at most ``distance`` differing bits, itself included.

    Null and empty texts have fingerprint zero and link like any other; repeated rows
    share a component; null keys are never the smallest unless all are null; an empty
    table gives an empty result.
    """
    found = stored(fingerprints(docs, shingle, (key,)), "simhash")
    classes = stored(found.groupBy("fp").agg(F.min(key).alias("_least")), "simhash-classes")
    roots = components(links(classes.select("fp"), distance, most=most))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    of = stored(rooted.join(named, "root").select("fp", "component_id"), "simhash-components")
    return found.join(of, "fp").select(key, "fp", "component_id")


def hex_digits(fp) -> Column:
    """The contract's form of a fingerprint: 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
