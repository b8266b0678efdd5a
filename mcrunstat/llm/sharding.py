"""Sharding by balanced label propagation: linked documents gather, shards stay even.

A label is a shard.  Documents of one group are linked pairwise; the links are never
written out, because all members of a group in one shard have the same neighbours: a round
counts the members of each group in each shard, and every (group, shard) part would move
to the shard where its group is strongest and room is left.  Parts move, most gain first,
as far as the room of the target goes, so a group larger than a shard fills several.
Rounds are Spark joins over a written table; the driver sees shard loads and a histogram of
at most shards x 64 x 256 sums.  Documents without a link are ballast: they fill the rooms
that are left, which makes the law hold exactly.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcrunstat.llm.common import stored

#: Rows that one window of ``numbered`` orders, about.
WINDOW_ROWS = 1 << 16
CLASSES, CELLS = 64, 256


def numbered(df: DataFrame, by: list[str], order: list[str], rows: int, weight: Column | None = None,
             name: str = "_before") -> DataFrame:
    """``df`` with the weight (1 unless given) of the rows before each row of its ``by`` group.

    Rows are ordered by a hash bucket and then by ``order`` (unique per row); a window never
    orders more than about ``WINDOW_ROWS`` rows, and bucket sums carry the totals over.
    """
    w = F.lit(1).cast("long") if weight is None else weight
    marked = df.withColumns({"_bucket": F.pmod(F.xxhash64(*order), F.lit(1 + rows // WINDOW_ROWS)), "_w": w})
    sums = marked.groupBy(*by, "_bucket").agg(F.sum("_w").alias("_sum"))
    ahead = Window.partitionBy(*by or [F.lit(0)]).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "_bucket", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = marked.withColumn("_in", F.coalesce(F.sum("_w").over(inner), F.lit(0)))
    return (out.join(starts, [*by, "_bucket"]).withColumn(name, F.col("_in") + F.col("_start"))
            .drop("_bucket", "_w", "_in", "_start"))


def _dealt(position: Column, edges: list[int]) -> Column:
    """Shard of a running total: the number of inner edges at or below it."""
    return reduce(lambda a, b: a + b, [(position >= F.lit(int(e))).cast("int") for e in edges], F.lit(0)).cast("int")


def _choose(cells: list, room: dict[int, int]) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
    """Per target: the last cell that moves as a whole, and of the next cell the weight
    that still fits.  ``cells`` holds (target, cell, weight)."""
    whole, part = {}, []
    left, closed = dict(room), set()
    for to, cell, weight in sorted(cells):
        if to in closed:
            continue
        if weight <= left[to]:
            left[to] -= weight
            whole[to] = cell
        else:
            closed.add(to)
            if left[to] > 0:
                part.append((to, cell, left[to]))
    return whole, part


def propagate(at: DataFrame, quota: list[int], rows: int, rounds: int) -> DataFrame:
    """``at`` (_row, g1, g2, _weight, shard) after rounds of moves; no shard passes its quota
    by a move.  Stops when nothing moves, or after ``rounds``."""
    for _ in range(rounds):
        parts = stored(at.groupBy("g1", "g2", "shard").agg(F.sum("_weight").alias("w")), "shard-parts")
        loads = {r.shard: r.w for r in parts.groupBy("shard").agg(F.sum("w").alias("w")).collect()}
        room = {s: q - loads.get(s, 0) for s, q in enumerate(quota)}
        open_ = [s for s, x in room.items() if x > 0]
        rank = F.struct("w", F.xxhash64("g1", "g2", "shard").alias("h"), "shard")
        best = (parts.filter(F.col("shard").isin(open_)).groupBy("g1", "g2").agg(F.max(rank).alias("best")))
        moves = (parts.join(best, ["g1", "g2"]).filter(rank < F.col("best"))
                 .select("g1", "g2", "shard", F.col("best.shard").alias("to"),
                         # cells in the order in which they may move: more neighbours at the target first
                         ((F.lit(CLASSES - 1) - F.floor(F.log2("best.w"))) * CELLS
                          + F.pmod(F.xxhash64("g2", "g1"), F.lit(CELLS))).cast("int").alias("cell"), "w"))
        moves = stored(moves, "shard-moves")
        cells = [tuple(r) for r in moves.groupBy("to", "cell").agg(F.sum("w")).collect()]
        whole, part = _choose(cells, room)
        if not whole and not part:
            break
        last = F.element_at(F.array(*[F.lit(whole.get(t, -1)) for t in range(len(quota))]), F.col("to") + 1)
        halves = {t: (cell, fits) for t, cell, fits in part}
        half, fits = (F.element_at(F.array(*[F.lit(halves.get(t, (-1, 0))[k]).cast("long") for t in range(len(quota))]),
                                   F.col("to") + 1) for k in (0, 1))
        chosen = (moves.withColumn("fits", F.when(F.col("cell") == half, fits)).filter((F.col("cell") <= last) | (F.col("cell") == half))
                  .select("g1", "g2", "shard", "to", "fits"))
        met = at.join(chosen, ["g1", "g2", "shard"], "left")
        new = met.filter("fits is null").select("_row", "g1", "g2", "_weight", F.coalesce("to", "shard").alias("shard"))
        if part:
            cut = numbered(met.filter("fits is not null"), ["to"], ["g1", "g2", "_row"], rows, F.col("_weight"))
            new = new.unionByName(cut.select("_row", "g1", "g2", "_weight", F.when(
                F.col("_before") + F.col("_weight") <= F.col("fits"), F.col("to")).otherwise(F.col("shard")).alias("shard")))
        at = stored(new, "shard-labels")
    return at


def place(nodes: DataFrame, shards: int, law: str = "rows", rounds: int = 12) -> DataFrame:
    """Shard and slot of every row of ``nodes``, whose columns ``_row`` (long, unique), ``g1`` and
    ``g2`` (longs: the group's 128-bit name; rows of one group are linked) and ``_size`` are read.

    ``law`` is ``rows`` (counts of rows at most one apart) or ``bytes`` (sums of ``_size`` near
    equal: a shard's share of the bytes, give or take its longest documents).  An empty table gives no
    rows; repeated rows are rows of their own; a group that no shard can hold fills several.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law {law!r}: rows or bytes")
    weight = F.lit(1).cast("long") if law == "rows" else F.col("_size").cast("long")
    sizes = nodes.groupBy("g1", "g2").agg(F.count("*").alias("n")).filter("n > 1").select("g1", "g2", F.lit(True).alias("_linked"))
    nodes = stored(nodes.withColumn("_weight", weight).join(sizes, ["g1", "g2"], "left"), "shard-nodes")
    seen = nodes.agg(F.count("*"), F.coalesce(F.sum("_weight"), F.lit(0)), F.count("_linked"),
                     F.coalesce(F.sum(F.when(F.col("_linked"), F.col("_weight"))), F.lit(0))).first()
    rows, total, n_linked, linked_weight = (int(x) for x in seen)
    quota = [total * (s + 1) // shards - total * s // shards for s in range(shards)]
    upto = np.cumsum([0, *quota])
    slim = ["_row", "g1", "g2", "_weight"]

    linked = numbered(nodes.filter("_linked").select(*slim), [], ["g1", "_row"], n_linked, F.col("_weight"))
    start = [linked_weight * int(x) // max(total, 1) for x in upto[1:-1]]
    at = propagate(stored(linked.select(*slim, _dealt(F.col("_before"), start).alias("shard")), "shard-labels"),
                   quota, rows, rounds)

    loads = {r.shard: r.w for r in at.groupBy("shard").agg(F.sum("_weight").alias("w")).collect()}
    edges = np.cumsum([max(q - loads.get(s, 0), 0) for s, q in enumerate(quota)])[:-1]
    alone = numbered(nodes.filter("_linked is null").select(*slim), [], ["g1", "_row"], rows, F.col("_weight"))
    labels = at.select("_row", "shard").unionByName(alone.select("_row", _dealt(F.col("_before"), list(edges)).alias("shard")))
    placed = stored(nodes.drop("_linked", "_weight").join(labels, "_row"), "shard-placed")
    return numbered(placed, ["shard"], ["g1", "_row"], rows, name="slot")


def shard_documents(docs: DataFrame, shards: int = 40, law: str = "rows", rounds: int = 12) -> DataFrame:
    """Documents (doc_id, text; other columns are not read) in shards, equal texts together as
    far as the law lets them: doc_id, size (UTF-8 bytes plus 16), text_crc32, law, shard, slot
    (gapless from 0 within the shard), grown_shard (null: only a law of keys has one).

    A null text counts as empty, and doc_id may be null or repeated.  Texts move nowhere: they
    are read once for their length, checksum and 128-bit name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = text.cast("binary")
    nodes = docs.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("_size"), F.crc32(raw).alias("text_crc32"),
                        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(7), text).alias("g2"))
    # numbers are given once, in a written table; a rerun task gives the same ones
    nodes = stored(nodes.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    return place(nodes, shards, law, rounds).select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit(law).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.concat(F.hex("g1"), F.hex("g2")).alias("group_name"))
