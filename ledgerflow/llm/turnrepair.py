"""Conversation repair: the cheapest edits that make roles alternate.

A conversation is its rows by turn (nulls first; equal turns by role, then by
the text's SHA-256). The first fault of a row counts: ``blank`` (no character but white
space), ``duplicate`` (role and text seen earlier), ``truncated`` (does not
end in ``.``, ``!`` or ``?``). Edits: Keep 0, Rerole to user or assistant 3,
Delete 4 (blank and duplicate rows must go), Insert an empty user or
assistant row 3; a truncated row that stays costs 3 more. Afterwards the role
initials read ``(s?(ua)+)?``. Of the cheapest audits (the edits' initials in
order) the ASCII-least is taken.

Run-length DP. Rows become symbols (role initial and fault). The costs from
each of the four states (start, after s, after u, after a) to the end form a
vector, and a symbol is a 4 x 4 min-plus matrix: insertions, then the row's edit.
Equal symbols in sequence are a run; a run is advanced by the binary powers
of its matrix, which are cached per symbol. The choices are then unrolled from
the front, the least initial first among those that stay on a cheapest path.

Hot conversations. Rows are numbered in one global order and cut into
segments of at most ``SEGMENT`` numbers, so that a task never holds more of a
conversation than that. A segment's matrix is the product of its runs; the
vectors behind each segment come from the matrices alone; every segment is
unrolled for each state that it could begin in, and the states are chained
along the segments. Only the digest (SHA-256 of a whole conversation)
streams a conversation's rows through one task, a batch at a time.

Nulls and odd rows: a null role or text reads as one space, null ids form one
conversation of their own, null turns come first, an empty role has no initial and
cannot be kept, repeated rows are duplicates; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, binary_column, ranked, stored

#: Rows of a conversation that one task holds, at most.
SEGMENT = 1 << 16

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FAR = 1 << 40  # no way
#: What the next kept row may be: (state, initial) -> state.
NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The state after a user or assistant row put in or reroled, which the state before decides.
PUT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
END = np.array([0, FAR, FAR, 0], np.int64)  # nothing at all, or an assistant last

# Symbols: role initial s, u, a or x (other), capital where truncated; "-" must go.
SYMBOLS = "suaxSUAX-"


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or a vector."""
    if b.ndim == 1:
        return np.minimum((a + b).min(axis=1), FAR)
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), FAR)


def _insertions() -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(m, 0)
    step = m.copy()
    for s in range(4):
        step[s, PUT[s]] = min(step[s, PUT[s]], INSERT)
    for _ in range(3):
        m = product(m, step)
    return m


INSERTIONS = _insertions()


def row_edits(symbol: str) -> list[tuple[str, int, Sequence[int]]]:
    """(initial, cost, the state after for each state; -1: not allowed)."""
    out = [("D", DELETE, (0, 1, 2, 3))]
    if symbol != "-":
        more = TRUNCATED if symbol.isupper() else 0
        out.append(("K", KEEP + more, tuple(NEXT.get((s, symbol.lower()), -1) for s in range(4))))
        out.append(("R", REROLE + more, PUT))
    return out


@cache
def power(symbol: str, k: int) -> np.ndarray:
    """Matrix of 2**k rows of one symbol."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    m = np.full((4, 4), FAR, np.int64)
    for _, cost, to in row_edits(symbol):
        for s, t in enumerate(to):
            if t >= 0:
                m[s, t] = min(m[s, t], cost)
    return product(INSERTIONS, m)


def run_advance(symbol: str, length: int, after: np.ndarray) -> np.ndarray:
    """``length`` equal symbols before ``after`` (a vector or a matrix)."""
    k = 0
    while length:
        if length & 1:
            after = product(power(symbol, k), after)
        length >>= 1
        k += 1
    return after


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def segment_matrix(symbols: str) -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(m, 0)
    for s, n in reversed(runs(symbols)):
        m = run_advance(s, n, m)
    return m


def before_end(after: np.ndarray, last: bool) -> np.ndarray:
    """The vector of costs after a segment's last row: insertions may still
    follow the conversation's last row."""
    return product(INSERTIONS, after) if last else after


def unroll(symbols: str, after: np.ndarray, state: int, last: bool) -> tuple[list[str], int]:
    """(edits for each row, insertions before it included, and those after the
    last row; the state they end in), from the costs after the segment."""
    behind = [before_end(after, last)]
    for s, n in reversed(runs(symbols)):
        behind.append(run_advance(s, n, behind[-1]))
    behind = behind[::-1]  # before each run, and after the last
    out: list[str] = []
    for i, (symbol, n) in enumerate(runs(symbols)):
        # Costs after each row of the run, from its last one.
        tails = [behind[i + 1]]
        for _ in range(n - 1):
            tails.append(product(power(symbol, 0), tails[-1]))
        edits = row_edits(symbol)
        here = behind[i]
        for j in range(n - 1, -1, -1):
            done = ""
            left = here[state]
            while True:
                options = [(e, cost, to[state]) for e, cost, to in edits if to[state] >= 0 and cost + tails[j][to[state]] == left]
                if options and options[0][0] == "D":
                    break
                # An insertion (I) comes before K and R.
                if _insert_here(edits, tails[j], PUT[state]) + INSERT == left:
                    done, state, left = done + "I", PUT[state], left - INSERT
                    continue
                break
            e, _, state = options[0]
            out.append(done + e)
            here = tails[j]
    tail = ""
    if last:
        while END[state]:
            tail, state = tail + "I", PUT[state]
    return [*out, tail], state


def _insert_here(edits: Sequence, after: np.ndarray, state: int) -> int:
    """Least cost from ``state`` before the row, more insertions allowed."""
    best, paid = FAR, 0
    for _ in range(4):
        best = min([best, *(paid + cost + after[to[state]] for _, cost, to in edits if to[state] >= 0)])
        state, paid = PUT[state], paid + INSERT
    return int(best)


def repair_one(symbols: str) -> tuple[int, str]:
    """(cost, audit) of one conversation's symbols."""
    cost = run_all(symbols)
    ops, _ = unroll(symbols, END, START, True)
    return cost, "".join(ops)


def run_all(symbols: str) -> int:
    v = before_end(END, True)
    for s, n in reversed(runs(symbols)):
        v = run_advance(s, n, v)
    return int(v[START])


def crc_bucket(conv: str, turn: str, n: int) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    return F.pmod(F.crc32(F.encode(F.concat(parts[0], F.lit(":"), parts[1]), "UTF-8")), F.lit(n))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with the damage that crc32 mod 20 deals:
    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4
    makes it the user's."""
    x = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                    F.coalesce(text, F.lit(" ")).alias("text")).withColumn("deal", crc_bucket("conv_id", "turn", 20))
    x = x.filter("deal != 0").withColumn("text", F.expr("case deal when 1 then '' when 2 then translate(text, '.!?', '') else text end"))
    x = x.withColumn("role", F.expr("if(deal = 4, 'user', role)"))
    return x.withColumn("copy", F.explode(F.expr("if(deal = 3, array(0, 1), array(0))"))).drop("deal", "copy")


def key(c: str) -> Column:
    """An id as a string that is never null, for joins."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias("conv")


def faults(rows: DataFrame) -> DataFrame:
    """Stored (num, conv, conv_id, turn, role, text, fault, symbol), num being
    the place in the order of conversations and turns; fault is null for none."""
    x = rows.withColumn("conv", key("conv_id")).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    x, _ = ranked(x, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")], "turns")
    x = x.withColumnRenamed("_rank", "num")
    # The digests alone say which rows come first; texts stay where they are.
    first = x.groupBy("conv", "role", "digest").agg(F.min("num").alias("num")).select("num", F.lit(True).alias("first"))
    flags = x.select("num", "conv", "role", F.expr(f"text not rlike '{_sql(WORD)}'").alias("blank"),
                     F.expr(r"rtrim(' \u0009\u000a\u000b\u000c\u000d', text) not rlike '[.!?]\\z'").alias("cut"))
    flags = flags.join(first, "num", "left")
    fault = F.expr("case when blank then 'blank' when first is null then 'duplicate' when cut then 'truncated' end")
    initial = F.expr("if(left(role, 1) in ('s', 'u', 'a'), left(role, 1), 'x')")
    flags = flags.withColumn("fault", fault).withColumn("initial", initial)
    symbol = F.expr("case when fault in ('blank', 'duplicate') then '-' when fault = 'truncated' then upper(initial) else initial end")
    return x.drop("digest"), flags.select("num", "conv", "fault", symbol.alias("symbol"))


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def edits(flags: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """((num, ops) per row: insertions before it and its own edit, with those
    after a conversation's last row in ``after``; (conv, cost))."""
    part = F.expr(f"num div {segment}").alias("part")
    segs = flags.groupBy("conv", part).agg(F.min("num").alias("num"), F.expr("array_join(transform(array_sort(collect_list(struct(num, symbol))), s -> s.symbol), '')").alias("symbols"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = [segment_matrix(s).ravel().tolist() for s in b.column("symbols").to_pylist()]
            yield b.append_column("matrix", pa.array(m, pa.list_(pa.int64())))
    segs = stored(segs.mapInArrow(matrices, "conv string, part long, num long, symbols string, matrix array<long>"), "segments")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, costs = [], []
            for chain in b.column("chain").to_pylist():  # 16 numbers a segment
                after, vs = END, []
                for i, s in enumerate(reversed(chain)):
                    vs.append((s["part"], after.tolist()))
                    after = product(np.array(s["matrix"]).reshape(4, 4), before_end(after, i == 0))
                out.append([{"part": p, "after": v, "last": i == 0, "first": i == len(vs) - 1} for i, (p, v) in enumerate(vs)])
                costs.append(int(after[START]))
            kind = pa.list_(pa.struct([("part", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_()), ("first", pa.bool_())]))
            yield pa.record_batch([b.column("conv"), pa.array(out, kind), pa.array(costs, pa.int64())], names=["conv", "segs", "cost"])
    chains = segs.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "matrix"))).alias("chain"))
    chains = stored(chains.mapInArrow(vectors, "conv string, segs array<struct<part:long,after:array<long>,last:boolean,first:boolean>>, cost long"), "vectors")

    def unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, part, num, symbols, after, last, first in zip(*(c.to_pylist() for c in b.columns)):
                after = np.array(after)
                able = before_end(after, last)
                for s, n in reversed(runs(symbols)):
                    able = run_advance(s, n, able)
                for state in range(1 if first else 4):
                    if able[state] < FAR:
                        ops, end = unroll(symbols, after, state, last)
                        rows.append((conv, part, num, state, end, ops[:-1], ops[-1]))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
    names = ["conv", "part", "num", "state", "end", "ops", "after"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string()]
    each = chains.select("conv", F.explode("segs").alias("s")).select("conv", "s.*")
    todo = segs.select("conv", "part", "num", "symbols").join(each, ["conv", "part"]).select("conv", "part", "num", "symbols", "after", "last", "first")
    ways = stored(todo.mapInArrow(unrolled, "conv string, part long, num long, state int, end int, ops array<string>, after string"), "ways")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, way in zip(b.column("conv").to_pylist(), b.column("way").to_pylist()):
                state, to = START, {(w["part"], w["state"]): w["end"] for w in way}
                for p in sorted({w["part"] for w in way}):
                    rows.append((conv, p, state))
                    state = to[p, state]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32()))], names=["conv", "part", "state"])
    way = ways.groupBy("conv").agg(F.collect_list(F.struct("part", "state", "end")).alias("way"))  # four numbers a segment
    taken = ways.join(way.mapInArrow(chained, "conv string, part long, state int"), ["conv", "part", "state"])
    last = F.expr("if(i = size(ops) - 1, after, '')")
    ops = taken.select("num", "after", "ops", F.posexplode("ops").alias("i", "op"))
    return ops.select((F.col("num") + F.col("i")).alias("num"), F.col("op").alias("ops"), last.alias("after")), chains.select("conv", "cost")


def repair(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(num, conv, conv_id, turn, role, text, fault, ops, after) for every row
    of (conv_id, turn, role, text); (conv, cost)."""
    x, flags = faults(rows)
    flags = stored(flags, "faults")
    ops, cost = edits(flags, segment)
    return x.join(flags.select("num", "fault").join(ops, "num"), "num"), cost


def repaired_lines(role: str, text: str, ops: str, state: int) -> tuple[list[str], int]:
    """What a row becomes: its lines ``role:text``, and the state after."""
    lines = []
    for e in ops:
        if e in "IR":
            state = PUT[state]
            lines.append(("user" if state == AFTER_U else "assistant") + ":" + (text if e == "R" else ""))
        elif e == "K":
            state = NEXT[state, role[:1]]
            lines.append(f"{role}:{text}")
    return lines, state


class _Digest:
    """What one conversation's rows, in order, add up to."""

    def __init__(self, conv_id):
        self.id, self.sha, self.state, self.audit, self.any = conv_id, hashlib.sha256(), START, [], False
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before, self.turns, self.low, self.turn = 0, None, 0, None, None

    def add(self, turn, role: str, text: str, fault: str | None, ops: str, after: str) -> None:
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        lines, self.state = repaired_lines(role, text, ops + after, self.state)
        for line in lines:
            self.sha.update((b"\n" if self.any else b"") + line.encode())
            self.any = True
        self.audit += ops + after

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return (self.id, gaps, *self.counts.values(), self.illegal, "".join(self.audit), self.sha.hexdigest())


def report(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The damage, repair and digest of every conversation: (conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    rows, cost = repair(damaged(conversations), segment)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, done = None, None, []
        for b in batches:
            # Texts as bytes, decoded one at a time.
            for c, conv_id, turn, role, text, fault, ops, after in zip(*(binary_column(b, "text") if n == "text" else b.column(n).to_pylist() for n in b.schema.names)):
                if c != conv:
                    if held:
                        done.append(held.row())
                    conv, held = c, _Digest(conv_id)
                held.add(turn, role, text.decode(), fault, ops, after)
            yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*done) if done else [()] * 8, kinds)], names=names)
            done = []
        if held:
            yield pa.record_batch([pa.array([v], k) for v, k in zip(held.row(), kinds)], names=names)
    cols = ["conv", F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "fault", "ops", "after"]
    x = rows.repartition("conv").sortWithinPartitions("conv", "num").select(*cols)
    found = x.mapInArrow(digest, ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in zip(names, kinds)))
    found = found.withColumn("conv", key("conv_id")).drop("conv_id").join(cost, "conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("conv", key("conv_id"))
    zero = {n: F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in (*names[1:6], "cost")}
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(found, "conv", "left").select("conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                                                   F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
