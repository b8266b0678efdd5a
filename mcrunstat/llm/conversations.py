"""Repair of conversations: the cheapest edits that give ``(s?(ua)+)?``, by branch and bound.

Spark finds the faults of the rows (blank, repeated, cut off) on slim rows of hashes, deals
them by conversation in order of turns, and a task searches each conversation as its rows
stream by; it keeps two bytes a row.  The texts travel once, each kept row's text once, to be
joined with their edits in order and hashed as they stream.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mcrunstat.llm.common import stored

DELETE, INSERT, KEEP, REROLE = b"DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT_OFF = 3

#: Row classes: initial s, u, a, other; plus 4 where cut off; GONE must be deleted.
INITIALS = "sua"
GONE = 8

#: States of the output: nothing yet, after s, after u, after a.
BEGIN, S, U, A = range(4)
FINAL = (True, False, False, True)
TURN = (U, U, A, U)  # where the next user or assistant row leads
ROLE = ("user", "user", "assistant", "user")

_FAR = 1 << 60


def _kept(state: int, row: int) -> int | None:
    """State after keeping a row's role, None where the pattern forbids it."""
    who = row & 3
    if who == 0:
        return S if state == BEGIN else None
    if who == 1:
        return U if state != U else None
    if who == 2:
        return A if state == U else None
    return None


def _closed(g: list[int]) -> tuple[int, int, int, int]:
    """Bounds that allow insertions at this place."""
    u, a = min(g[U], COST[INSERT] + g[A]), min(g[A], COST[INSERT] + g[U])
    return min(g[BEGIN], COST[INSERT] + u), min(g[S], COST[INSERT] + u), u, a


def bounds(rows: bytes) -> array:
    """Lower bounds of the cost of every suffix in every state, 4 to a place.

    Relaxed only in the audit: the least cost over all edits of the suffix, whatever their
    letters, so a bound never passes the true cost.
    """
    n = len(rows)
    out = array("q", bytes(32 * (n + 1)))
    now = _closed([0 if f else _FAR for f in FINAL])
    out[4 * n: 4 * n + 4] = array("q", now)
    for i in range(n - 1, -1, -1):
        row = rows[i]
        g = [COST[DELETE] + x for x in now]
        if row != GONE:
            more = CUT_OFF if row & 4 else 0
            for q in range(4):
                k = _kept(q, row)
                if k is not None and more + now[k] < g[q]:
                    g[q] = more + now[k]
                x = COST[REROLE] + more + now[TURN[q]]
                if x < g[q]:
                    g[q] = x
        now = _closed(g)
        out[4 * i: 4 * i + 4] = array("q", now)
    return out


def search(rows: bytes) -> tuple[int, bytes]:
    """(cost, audit) of the cheapest edits, of equal costs the ASCII-least audit.

    Depth first with an explicit stack.  A node is (place, state); a prefix is dropped where
    its cost and the suffix bound reach the incumbent's cost, or where its node was reached at no more
    cost.  Children are tried by bound and then by letter, and prefixes of equal cost reach a node
    in the order of their audits (a shorter audit that begins a longer one costs less), so
    of equally good prefixes and repairs the first one found is the one to keep.
    """
    n = len(rows)
    least = bounds(rows)
    table = array("q", [_FAR]) * (4 * (n + 1))
    best, audit = _FAR, b""
    path = bytearray()
    stack = [(0, 0, 0, BEGIN, 0)]  # audit length before, letter, place, state, cost
    while stack:
        depth, letter, i, q, cost = stack.pop()
        node = 4 * i + q
        if cost + least[node] >= best or cost >= table[node]:
            continue
        table[node] = cost
        del path[depth:]
        if letter:
            path.append(letter)
        depth = len(path)
        if i == n and FINAL[q]:
            best, audit = cost, bytes(path)
            continue
        children = [(INSERT, i, TURN[q], cost + COST[INSERT])]
        if i < n:
            row = rows[i]
            children.append((DELETE, i + 1, q, cost + COST[DELETE]))
            if row != GONE:
                more = cost + (CUT_OFF if row & 4 else 0)
                k = _kept(q, row)
                if k is not None:
                    children.append((KEEP, i + 1, k, more))
                children.append((REROLE, i + 1, TURN[q], more + COST[REROLE]))
        children.sort(key=lambda c: (c[3] + least[4 * c[1] + c[2]], c[0]), reverse=True)
        stack += [(depth, *c) for c in children]
    return best, audit


@lru_cache(maxsize=1 << 15)
def _search_short(rows: bytes) -> tuple[int, bytes]:
    return search(rows)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn`` modulo 20, with
    the column ``copies`` (0: dropped, 2: repeated).  Nulls count as one space."""
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text")))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(_text("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


class _Conversation:
    """What a task knows of the conversation that streams by: two bytes a row."""

    def __init__(self):
        self.rows = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.before = None

    def add(self, turn, who: int, blank: bool, cut: bool, again: bool, copies: int) -> None:
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.before is not None and (self.before, who) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.illegal += copies - 1
        self.before = who
        if blank:
            self.blank += copies
        elif again:
            self.duplicate += copies
        else:
            self.duplicate += copies - 1
            self.truncated += cut
        self.rows.append(GONE if blank or again else who + 4 * cut)
        self.rows += bytes([GONE]) * (copies - 1)

    def result(self) -> tuple:
        rows = bytes(self.rows)
        cost, audit = (_search_short if len(rows) <= 64 else search)(rows)
        # the plan: letters of the rows that may stay, and the insertions
        plan, at = bytearray(), 0
        for letter in audit:
            if letter != INSERT:
                at += 1
                if rows[at - 1] == GONE:
                    continue
            plan.append(letter)
        gaps = self.high - self.low + 1 - self.distinct if self.high is not None else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit.decode(), plan.decode()


FOUND = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "plan")
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
_SCHEMA = ", ".join(f"{c} {t}" for c, t in zip(FOUND, ["long"] * 6 + ["string"] * 2))
ID = "_conv"
FLUSH = 4096


def _table(ids: list, id_type, rows: list[tuple], names: tuple, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type)] + [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      [ID, *names])


def _audits(batches):
    """Slim rows, sorted by conversation and place, to a row per conversation."""
    now, state, ids, found, kind = None, None, [], [], None
    for b in batches:
        kind = b.schema.field(ID).type
        cols = [b.column(c).to_pylist() for c in (ID, "turn", "who", "blank", "cut", "again", "copies")]
        for i, *fact in zip(*cols):
            if state is None or i != now:
                if state is not None:
                    ids.append(now)
                    found.append(state.result())
                now, state = i, _Conversation()
            state.add(*fact)
        if len(ids) >= FLUSH:
            yield _table(ids, kind, found, FOUND, _TYPES)
            ids, found = [], []
    if state is not None:
        yield _table([*ids, now], kind, [*found, state.result()], FOUND, _TYPES)


class _Writer:
    """Hash of a repaired conversation, row by row."""

    def __init__(self, plan: str):
        self.plan, self.at, self.state, self.hash, self.any = plan, 0, BEGIN, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def inserts(self) -> None:
        while self.at < len(self.plan) and self.plan[self.at] == "I":
            self._put(ROLE[self.state], "")
            self.state = TURN[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.plan[self.at]
        self.at += 1
        if letter == "K":
            self._put(role, text)
            k = _kept(self.state, INITIALS.find(role[:1]) if role[:1] else 3)
            self.state = k
        elif letter == "R":
            self._put(ROLE[self.state], text)
            self.state = TURN[self.state]

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def _hashes(batches):
    """Plans, each followed by its conversation's rows in order, to a hash per conversation."""
    names, types = (*FOUND[:-1], "repaired_sha256"), [*_TYPES[:-1], pa.string()]
    now, writer, head, ids, out, kind = None, None, None, [], [], None
    for b in batches:
        kind = b.schema.field(ID).type
        for i, found, role, text in zip(*(b.column(c).to_pylist() for c in (ID, "found", "role", "text"))):
            if found is None:
                writer.row(role, text)
                continue
            if writer is not None:
                ids.append(now)
                out.append((*head, writer.digest()))
            now, writer, head = i, _Writer(found["plan"]), [found[c] for c in FOUND[:-1]]
        if len(ids) >= FLUSH:
            yield _table(ids, kind, out, names, types)
            ids, out = [], []
    if writer is not None:
        yield _table([*ids, now], kind, [*out, (*head, writer.digest())], names, types)


def repair(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (conv_id, turn, role, text, copies; ``copies`` equal
    rows stand side by side, none where 0; other columns are not read): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are ordered by turn (nulls first), role and the text's 128-bit name.  A null conv_id
    is a conversation of its own, a null role or text counts as one space, an empty table gives
    no rows, and a row that repeats counts as often as it is there.  SHA-256 reads a conversation
    in order, so one task streams the kept texts of a conversation; it holds one at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    named = rows.select(
        F.col("conv_id").alias(ID), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.col("copies").cast("long").alias("copies")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text"),
         "last": F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))})
    # equal rows are one before they meet, and a row's earlier equals are found by text, not by
    # conversation, so that a conversation of any length is spread
    slim = (named.groupBy(ID, "turn", "role", "h1", "h2", "last").agg(F.sum("copies").alias("copies")))
    seen = Window.partitionBy(ID, "role", "h1", "h2").orderBy(F.col("copies") == 0, F.asc_nulls_first("turn"))
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("h1"), F.col("h2")]
    who = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    facts = (slim.withColumn("again", F.row_number().over(seen) > 1)
             .withColumn("who", F.when((F.col("role") == "") | (who < 0), 3).otherwise(who))
             .withColumns({"blank": F.col("last") == "", "cut": ~F.col("last").isin("", ".", "!", "?")})
             .repartition(ID).sortWithinPartitions(F.asc_nulls_first(ID), *order)
             .select(ID, "turn", "who", "blank", "cut", "again", "copies"))
    audits = stored(facts.mapInArrow(_audits, f"{ID} {kind}, {_SCHEMA}"), "conversation-audits")

    texts = (named.filter("copies > 0 and last <> ''").groupBy(ID, "role", "h1", "h2")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"), F.min("text").alias("text"))
             .select(ID, F.col("at.turn").alias("turn"), "role", "h1", "h2", "text"))
    lines = audits.select(ID, F.struct(*FOUND).alias("found")).unionByName(texts, allowMissingColumns=True)
    hashed = (lines.repartition(ID).sortWithinPartitions(F.asc_nulls_first(ID), F.col("found").isNull(), *order)
              .select(ID, "found", "role", "text")
              .mapInArrow(_hashes, f"{ID} {kind}, {_SCHEMA.rsplit(',', 1)[0]}, repaired_sha256 string"))
    return hashed.withColumnRenamed(ID, "conv_id")
