"""Functional-dependency discovery and 3NF synthesis (NF-3).

Discovery alternates between a bounded sample and the whole table (after
HyFD: Papenbrock, Naumann, SIGMOD 2016). On the sample, held in numpy as one
code per cell, the lattice of left sides is searched level by level: a left
side's stripped partition (its groups of two rows and more) is refined by one
column at a time, and X -> A holds if no group of X has two values of A. What
holds on the sample is then verified on all rows: one aggregate per left
side, grouped by it, checks all its right sides at once by their smallest and
largest values, so rows are combined before they move. A refuted dependency
gives a few of the rows that refute it; they join the sample, and the search
starts anew. Every round refutes something, and a dependency that is
returned has been verified on every row.

Synthesis (Bernstein, TODS 1976): a minimal cover, one relation per left
side, equivalent left sides merged, and one more relation for a key of the whole
if no relation holds one.

NULL is a value like any other, equal to itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep

FD = tuple[frozenset, str]

#: Rows of the first sample, at most, and rows that one refuted left side adds.
SAMPLE_ROWS = 10_000
EVIDENCE_GROUPS = 20


def _codes(rows: list[tuple], n: int) -> np.ndarray:
    """One small number per distinct value of each column; NULL is a value."""
    out = np.empty((len(rows), n), np.int64)
    for c in range(n):
        known: dict = {}
        out[:, c] = [known.setdefault(r[c], len(known)) for r in rows]
    return out


def _refine(partition: list[np.ndarray], codes: np.ndarray) -> list[np.ndarray]:
    """Groups of two and more rows that also agree in another column."""
    out = []
    for g in partition:
        v = codes[g]
        order = np.argsort(v, kind="stable")
        cut = np.flatnonzero(np.diff(v[order])) + 1
        out += [p for p in np.split(g[order], cut) if len(p) > 1]
    return out


def dependencies_of_rows(rows: list[tuple], columns: Sequence[str], max_left: int) -> set[FD]:
    """Minimal X -> A with up to ``max_left`` columns in X that the rows hold."""
    codes = _codes(rows, len(columns))
    at = {c: i for i, c in enumerate(columns)}
    whole = [np.arange(len(rows))] if len(rows) > 1 else []
    level: dict[frozenset, list[np.ndarray]] = {frozenset(): whole}
    found: set[FD] = set()
    left_of: dict[str, list[frozenset]] = {c: [] for c in columns}
    for size in range(max_left + 1):
        for x, partition in level.items():
            for a in columns:
                if a in x or any(y <= x for y in left_of[a]):
                    continue
                v = codes[:, at[a]]
                if all((v[g] == v[g[0]]).all() for g in partition):
                    found.add((x, a))
        for x, a in found:
            if len(x) == size:
                left_of[a].append(x)
        if size == max_left:
            break
        following = {}
        for x, partition in level.items():
            for c in columns[(max(map(at.get, x)) + 1 if x else 0):]:
                # A column that X decides already adds nothing to a minimal left side.
                if not any(y <= x for y in left_of[c]):
                    following[x | {c}] = _refine(partition, codes[:, at[c]])
        level = following
    return found


def _sample(df: DataFrame, columns: Sequence[str], rows: int) -> list[tuple]:
    """Rows that agree with others: those with the smallest hashes of each column in turn."""
    share = max(1, rows // len(columns))
    out = []
    for c in columns:
        out += [tuple(r) for r in df.orderBy(F.xxhash64(c), *columns).limit(share).collect()]  # rows / columns at most
    return out


def refuted(df: DataFrame, fds: Iterable[FD], columns: Sequence[str]) -> set[FD]:
    """Those of ``fds`` that some rows of ``df`` contradict: an aggregate per
    left side, one number per dependency to the driver."""
    by_left: dict[frozenset, list[str]] = {}
    for x, a in fds:
        by_left.setdefault(x, []).append(a)
    checks = []
    for i, (x, rights) in enumerate(by_left.items()):
        per = df.groupBy(*sorted(x)).agg(*[_differs(a).alias(f"d{j}") for j, a in enumerate(rights)])
        total = per.agg(*[F.coalesce(F.max(F.col(f"d{j}").cast("int")), F.lit(0)).alias(f"d{j}") for j in range(len(rights))])
        checks.append(total.select(F.lit(i).alias("left"), F.array(*[f"d{j}" for j in range(len(rights))]).alias("bad")))
    bad = {r["left"]: r["bad"] for r in reduce(DataFrame.unionByName, checks).collect()} if checks else {}
    return {(x, a) for i, (x, rights) in enumerate(by_left.items()) for j, a in enumerate(rights) if bad[i][j]}


def _differs(a: str):
    some = F.count(a)
    return (F.min(a) != F.max(a)) & (some > 0) | (some > 0) & (some < F.count(F.lit(1)))


def _evidence(df: DataFrame, x: frozenset, a: str, columns: Sequence[str], groups: int) -> list[tuple]:
    """Two rows of each of a few groups of X that differ in A."""
    if x:
        keys = [F.col(c) for c in sorted(x)]
        bad = df.groupBy(*sorted(x)).agg(_differs(a).alias("_d")).filter("_d").limit(groups)  # groups rows at most
        same = reduce(lambda p, q: p & q, [F.col(f"b.{c}").eqNullSafe(F.col(f"r.{c}")) for c in sorted(x)])
        rows = df.alias("r").join(F.broadcast(bad.select(*keys)).alias("b"), same, "left_semi")
    else:
        rows = df
    whole = F.struct(*columns)
    pair = rows.groupBy(*sorted(x)).agg(F.min_by(whole, F.struct(F.col(a).isNull(), a)).alias("p"), F.max_by(whole, F.struct(F.col(a).isNull(), a)).alias("q"))
    return [tuple(r[s]) for r in pair.select("p", "q").collect() for s in ("p", "q")]


def discover(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 1, sample_rows: int = SAMPLE_ROWS) -> set[FD]:
    """All minimal dependencies X -> A among ``columns`` with at most
    ``max_left`` columns in X. Larger left sides find more dependencies that
    hold by chance only. ``df`` is read once per round and left side: pass a
    written table."""
    columns = list(columns or df.columns)
    df = df.select(*columns)
    rows = _sample(df, columns, sample_rows)
    verified: set[FD] = set()
    while True:
        found = dependencies_of_rows(rows, columns, max_left)
        wrong = refuted(df, found - verified, columns)
        verified |= found - wrong
        if not wrong:
            return found
        for x in {x for x, _ in wrong}:
            for a in sorted(a for y, a in wrong if y == x):
                rows += _evidence(df, x, a, columns, EVIDENCE_GROUPS)


# --- inclusion: which columns refer to which ----------------------------------
def inclusions(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(column, refers_to, n_values, n_target): all pairs of different columns
    whose values, NULL aside, are all found in the other (candidates for foreign
    keys of an unknown database). Pass columns that may be compared; values
    are compared as text.

    Each value is shuffled once per column that has it. Values that occur in the same set of columns
    are then counted together, so pairs are formed from sets of columns, of
    which there are few, never from values (the test of Bauckmann et al., ICDE
    2007, as two aggregates)."""
    names = [f"{t}.{c}" for t, (_, cols) in tables.items() for c in cols]
    parts = [df.select(F.lit(names.index(f"{t}.{c}")).alias("at"), F.col(c).cast("string").alias("v")).filter("v is not null").distinct()
             for t, (df, cols) in tables.items() for c in cols]
    sets = reduce(DataFrame.unionByName, parts).groupBy("v").agg(F.array_sort(F.collect_set("at")).alias("s"))  # one entry per column
    sets = keep(sets.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "inclusion-sets")
    each = sets.select("s", "n", F.explode("s").alias("a"))
    size = each.groupBy("a").agg(F.sum("n").alias("n"))
    shared = each.select("n", "a", F.explode("s").alias("b")).filter("a <> b").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    x = shared.join(size, "a").filter("shared = n").join(size.toDF("b", "m"), "b")
    name = F.array(*[F.lit(n) for n in names])
    return x.select(F.get(name, F.col("a")).alias("column"), F.get(name, F.col("b")).alias("refers_to"), F.col("n").alias("n_values"), F.col("m").alias("n_target"))


# --- cover and synthesis: sets of column names only -----------------------------
def closure(columns: Iterable[str], fds: Iterable[FD]) -> frozenset:
    """All columns that ``columns`` decide."""
    known, fds = set(columns), list(fds)
    while True:
        more = {a for x, a in fds if a not in known and x <= known}
        if not more:
            return frozenset(known)
        known |= more


def _order(fd: FD, at: dict[str, int]) -> tuple:
    return len(fd[0]), sorted(at[c] for c in fd[0]), at[fd[1]]


def minimal_cover(fds: Iterable[FD], columns: Sequence[str]) -> list[FD]:
    """Dependencies from which all follow, none of them superfluous; of
    equals, those with later columns go first."""
    at = {c: i for i, c in enumerate(columns)}
    keep = sorted(set(fds), key=lambda fd: _order(fd, at))
    for fd in list(reversed(keep)):
        rest = [f for f in keep if f != fd]
        if fd[1] in closure(fd[0], rest):
            keep = rest
    return keep


def a_key(columns: Sequence[str], fds: Iterable[FD]) -> frozenset:
    """A minimal set of columns that decides all; later columns are left out first."""
    fds, key = list(fds), list(columns)
    for c in reversed(columns):
        if closure([k for k in key if k != c], fds) >= set(columns):
            key.remove(c)
    return frozenset(key)


def synthesize(columns: Sequence[str], fds: Iterable[FD]) -> list[tuple[list[str], list[str]]]:
    """(key, columns) of 3NF relations, in the order of their keys' columns."""
    at = {c: i for i, c in enumerate(columns)}
    cover = minimal_cover(fds, columns)
    relations: list[tuple[list[str], set]] = []
    lefts = sorted({x for x, _ in cover}, key=lambda x: (len(x), sorted(map(at.get, x))))
    while lefts:
        x = lefts.pop(0)
        same = [x, *(y for y in lefts if x <= closure(y, cover) and y <= closure(x, cover))]  # left sides that decide each other
        lefts = [y for y in lefts if y not in same]
        # What equivalent left sides decide, but not what another relation is there for.
        relations.append((sorted(x, key=at.get), set().union(*same, {a for y, a in cover if y in same})))
    relations = [(k, c) for i, (k, c) in enumerate(relations) if not any(c < d or c == d and j < i for j, (_, d) in enumerate(relations) if j != i)]
    key = a_key(columns, fds)
    if not any(closure(c, cover) >= set(columns) for _, c in relations):
        relations.append((sorted(key, key=at.get), set(key)))
    return sorted(((k, sorted(c, key=at.get)) for k, c in relations), key=lambda r: ([at[c] for c in r[0]], r[1]))


def is_minimal(fds: Iterable[FD]) -> bool:
    fds = set(fds)
    return not any((frozenset(y), a) in fds for x, a in fds for n in range(len(x)) for y in combinations(sorted(x), n))
