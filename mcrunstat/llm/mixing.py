"""Mixing sources to target weights: a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern).  The
flow network has an arc into each pattern per repetition (capacity: the pattern's
tokens, cost: the repetition's number, so costs are convex), arcs from a pattern to its
sources, and an arc from each source to the sink with the source's quota.  Only the
arcs into patterns cost anything, so the cheapest augmenting paths are those of the
lowest repetition: augmenting to a maximum flow repetition by repetition is successive
shortest paths.  A pattern's flow then becomes whole passes over its documents plus a
seeded selection of documents for the rest.

Only one row per pattern reaches the driver, at most ``max_patterns`` (an error beyond).
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mcrunstat.llm.common import stored, word_count

BUCKETS = 1 << 16


def shared_targets(sizes: dict, weights: dict, total: float, most: float = 2.0) -> dict:
    """``total`` dealt by weight; a share above ``most`` times its source's size stops
    there and the excess is dealt again among the others until none is above."""
    target, free, left = {}, list(sizes), float(total)
    while free:
        weight = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / weight > most * sizes[s]]
        if not over:
            target.update((s, left * weights[s] / weight) for s in free)
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in target]
    return target


def route(patterns: Sequence[tuple[Sequence, int]], quotas: dict, repeats: int = 2) -> list[int]:
    """Flow out of each pattern (its tokens times passes) that fills the quotas as far as
    capacity goes, at the least total repetition cost."""
    source, sink = ("from",), ("to",)
    cap: dict[tuple, dict] = defaultdict(dict)

    def arc(a, b, c):
        cap[a][b] = cap[a].get(b, 0) + c
        cap[b].setdefault(a, 0)

    unlimited = sum(quotas.values()) + 1
    for i, (members, _) in enumerate(patterns):
        arc(source, ("p", i), 0)
        for s in members:
            arc(("p", i), ("s", s), unlimited)
    for s, q in quotas.items():
        arc(("s", s), sink, q)
    for _ in range(repeats):
        for i, (_, tokens) in enumerate(patterns):
            cap[source][("p", i)] += tokens
        _augment(cap, source, sink)
    return [cap[("p", i)][source] for i in range(len(patterns))]


def _augment(cap: dict, source: tuple, sink: tuple) -> None:
    """Maximum flow by level graphs and blocking flows, without recursion."""
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, c in cap[a].items():
                if c > 0 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return
        todo = {a: iter(list(cap[a])) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                least = min(cap[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    cap[x][y] -= least
                    cap[y][x] += least
                at = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if not cap[x][y])
                todo = {x: iter(list(cap[x])) if x in path[: at + 1] else t for x, t in todo.items()}
                path = path[: at + 1]
                continue
            for b in todo[a]:
                if cap[a][b] > 0 and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
            else:
                path.pop()


_CUTS = "_cuts array<struct<most:long,bucket:int,order:long,size:long,id:long>>"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return df.hint("broadcast") if rows < 10_000 else df


def _inside() -> Column:
    """Is the document before one of the cuts of its pattern, and no larger than that cut takes?"""
    place = F.struct(F.col("_bucket"), F.col("_order"), F.col("size"), F.col("_id"))
    return F.exists("_cuts", lambda c: (F.col("size") <= c["most"]) & (
        place <= F.struct(c["bucket"], c["order"], c["size"], c["id"])))


def _selection(keyed: DataFrame, left: dict[str, int], near: dict[str, float]) -> tuple[dict, dict]:
    """Which documents fill ``left`` tokens of each pattern: cuts and single documents.

    A round takes, of the documents that fit the gap and were not taken, the longest run in
    hash order that fits; the next one is larger than the new gap and drops out.  So the gap
    about halves in a round.  A round is two aggregations over slim rows: sums of hash
    buckets, then a running sum inside one bucket of each pattern; a row a pattern comes to
    the driver.
    """
    spark = keyed.sparkSession
    slim = keyed.filter("size > 0").select("_key", "_bucket", "_order", "size", "_id")
    cuts: dict[str, list] = {p: [] for p in left}
    gap, live = dict(left), set(left)
    while live:
        live = {p for p in live if gap[p] > near[p]}
        if not live:
            break
        now = spark.createDataFrame([(p, gap[p], cuts[p]) for p in sorted(live)], f"_key string, _gap long, {_CUTS}")
        fits = slim.join(_small(now, len(live)), "_key").filter((F.col("size") <= F.col("_gap")) & ~_inside())
        in_order = Window.partitionBy("_key").orderBy("_bucket")
        sums = (fits.groupBy("_key", "_bucket").agg(F.sum("size").alias("n"), F.first("_gap").alias("_gap"))
                .withColumn("_before", F.sum("n").over(in_order) - F.col("n")))
        over = F.col("_before") + F.col("n") > F.col("_gap")
        found = sums.groupBy("_key").agg(F.sum("n").alias("n"), F.min(
            F.when(over, F.struct("_bucket", "_before"))).alias("edge")).collect()
        edges = [(r._key, r.edge._bucket, r.edge._before) for r in found if r.edge is not None]
        for r in found:
            if r.edge is None:  # all that fit are taken
                cuts[r._key].append((gap[r._key], 1 << 16, 0, 0, 0))
                gap[r._key] -= r.n
        live = {p for p, *_ in edges}
        if not edges:
            break
        edge = _small(spark.createDataFrame(edges, "_key string, _bucket int, _before long"), len(edges))
        run = Window.partitionBy("_key").orderBy("_order", "size", "_id").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        last = (fits.join(edge, ["_key", "_bucket"]).withColumn("_sum", F.sum("size").over(run) + F.col("_before"))
                .filter("_sum <= _gap").groupBy("_key").agg(F.max(F.struct("_sum", "_order", "size", "_id")).alias("at")))
        ends = {r._key: r["at"] for r in last.collect()}
        for p, bucket, before in edges:
            at = ends.get(p)
            cuts[p].append((gap[p], bucket, -(1 << 63), -1, -1) if at is None
                           else (gap[p], bucket, at._order, at["size"], at._id))
            gap[p] -= before if at is None else at._sum
    ones: dict[str, int] = {}
    open_ = [(p, cuts[p]) for p in sorted(gap) if gap[p] > near[p]]
    if open_:
        plan = _small(spark.createDataFrame(open_, f"_key string, {_CUTS}"), len(open_))
        least = (slim.join(plan, "_key").filter(~_inside()).groupBy("_key")
                 .agg(F.min(F.struct("size", "_order", "_id")).alias("least")))
        ones = {r._key: r.least._id for r in least.collect() if r.least["size"] < 2 * gap[r._key]}
    return cuts, ones


def mix(docs: DataFrame, members: str, size: str, quotas: Callable[[dict], dict], carry: Iterable[str] = (),
        repeats: int = 2, seed: int = 7, max_patterns: int = 100_000, near: float = 0.005) -> tuple[DataFrame, dict, dict]:
    """Documents with ``times`` (how often the mix takes them) and ``taken`` (tokens, repeats
    counted), the sizes of the sources and the quotas.

    ``docs`` has an array column ``members`` (sources; null is a source of its own) and a
    long column ``size`` (null: 0); ``carry`` columns pass through.  ``quotas`` gets the
    source sizes and returns tokens wanted of each.  Documents of a pattern are selected
    in the order of a seeded hash of their carried columns; one that does not fit any more is
    passed over and later ones are tried until at most ``near`` of the flow is open or none
    fits, and then the smallest one left is taken if that brings the sum nearer.  Documents of size 0 are taken 0 times their
    size, repeated rows count each on its own, documents without sources stay with 0,
    and an empty table gives an empty result.
    """
    spark, carry = docs.sparkSession, list(carry)
    rows = stored(docs.select(
        *[F.col(f"`{c}`") for c in carry],
        F.to_json(F.array_sort(F.array_distinct(F.col(members)))).alias("_pattern"),
        F.array_distinct(F.col(members)).alias("_members"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in carry]).alias("_order"),
    ).withColumns({"_bucket": F.shiftrightunsigned("_order", 48).cast("int"), "_id": F.monotonically_increasing_id()}), "mix")
    found = rows.groupBy("_pattern").agg(F.first("_members").alias("m"), F.sum("size").alias("n")).limit(
        max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    sizes: dict = defaultdict(int)
    for r in found:
        for s in r.m or ():
            sizes[s] += r.n
    wanted = quotas(dict(sizes))
    patterns = [(r.m or (), r.n) for r in sorted(found, key=lambda r: r._pattern or "")]
    names = sorted((r._pattern or "" for r in found))
    flows = route(patterns, {s: round(q) for s, q in wanted.items()}, repeats)
    keyed = rows.withColumn("_key", F.coalesce("_pattern", F.lit("")))
    left = {p: f % n for p, f, (_, n) in zip(names, flows, patterns) if n and f % n}
    cuts, ones = _selection(keyed, left, {p: near * f for p, f in zip(names, flows)})
    plan = spark.createDataFrame([(p, f // n if n else 0, cuts.get(p, []), ones.get(p))
                                  for p, f, (_, n) in zip(names, flows, patterns)], f"_key string, _passes long, {_CUTS}, _one long")
    dealt = keyed.join(_small(plan, len(found)), "_key")
    times = F.col("_passes") + (_inside() | F.coalesce(F.col("_id") == F.col("_one"), F.lit(False))).cast("long")
    out = dealt.withColumn("times", times).select(
        *[F.col(f"`{c}`") for c in carry], F.col("_members").alias("members"), "size",
        "times", (F.col("times") * F.col("size")).alias("taken"))
    return out, dict(sizes), wanted


def weighted(sizes: dict, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Targets of sources by code point, null last, with repeating ``weights``; together
    ``share`` times all sizes, none above ``most`` times its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    by = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    return shared_targets({s: sizes[s] for s in order}, by, share * sum(sizes.values()), most)


def mix_by_source(docs: DataFrame, key: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The mix of ``documents``: key columns, source, size, source_size, target, taken."""
    key = list(key)
    sized = docs.select(*[F.col(f"`{c}`") for c in key], F.array(F.col("source")).alias("_members"),
                        word_count(F.col("text")).alias("_size"))
    out, sizes, targets = mix(sized, "_members", "_size", weighted, key)
    facts = docs.sparkSession.createDataFrame(
        [(s, n, float(targets[s])) for s, n in sizes.items()], "source string, source_size long, target double")
    one = out.withColumn("_source", F.element_at("members", 1))
    return (one.join(facts, F.col("_source").eqNullSafe(F.col("source")))
            .select(*key, "source", "size", "source_size", "target", "taken"))
