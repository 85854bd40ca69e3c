"""Dependency discovery against brute force; synthesis; proofs on NULL keys."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from ledgerflow.operators import dependencies as fd
from ledgerflow.operators import model as nf
from ledgerflow.session import keep


def brute(rows, columns, max_left):
    at = {c: i for i, c in enumerate(columns)}
    found = set()
    for n in range(max_left + 1):
        for x in combinations(columns, n):
            for a in columns:
                if a in x or any((frozenset(y), a) in found for m in range(n) for y in combinations(x, m)):
                    continue
                seen = {}
                if all(seen.setdefault(tuple(r[at[c]] for c in x), r[at[a]]) == r[at[a]] for r in rows):
                    found.add((frozenset(x), a))
    return found


def _random_rows(rnd, n):
    """g -> h, (a, b) -> c, k a constant, some NULLs, the rest by chance."""
    rows = []
    for _ in range(n):
        g, a, b = rnd.randrange(40), rnd.randrange(12), rnd.choice([None, *range(9)])
        rows.append((g, None if g % 7 == 0 else g // 3, a, b, (a * 31 + (b or -5)) % 17, "k", rnd.randrange(5)))
    return rows


COLUMNS = list("ghabckz")
SCHEMA = "g int, h int, a int, b int, c int, k string, z int"


def test_rows_match_brute_force():
    rnd = random.Random(1)
    for n in (0, 1, 2, 5, 30, 400):
        rows = _random_rows(rnd, n)
        for left in (0, 1, 2, 3):
            got = fd.dependencies_of_rows(rows, COLUMNS, left)
            assert got == brute(rows, COLUMNS, left) and fd.is_minimal(got)


def test_discovery_verifies_on_all_rows_whatever_the_sample(spark):
    rows = _random_rows(random.Random(2), 700)
    df = spark.createDataFrame(rows, SCHEMA).checkpoint()
    for left, sample in ((1, 7), (2, 14), (2, 10_000)):
        assert fd.discover(df, COLUMNS, left, sample_rows=sample) == brute(rows, COLUMNS, left)
    empty = df.limit(0)
    assert fd.discover(empty, ["g", "h"], 1) == {(frozenset(), "g"), (frozenset(), "h")}


def test_refuted_sees_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, None), (2, 5, 1)], "x int, y int, z int")
    x = frozenset("x")
    assert fd.refuted(df, {(x, "y"), (x, "z"), (frozenset(), "y")}, ["x", "y", "z"]) == {(x, "z"), (frozenset(), "y")}


def test_synthesis_is_lossless_covers_and_has_keys():
    rnd = random.Random(3)
    columns = list("abcdefg")
    for _ in range(200):
        fds = {(frozenset(rnd.sample(columns, rnd.randint(1, 2))), rnd.choice(columns)) for _ in range(rnd.randint(0, 6))}
        fds = {(x, a) for x, a in fds if a not in x}
        parts = fd.synthesize(columns, fds)
        assert {c for _, cols in parts for c in cols} >= {a for _, a in fds}
        assert any(fd.closure(cols, fds) >= set(columns) for _, cols in parts)  # one holds a key, so the join is lossless
        for key, cols in parts:
            assert fd.closure(key, fds) >= set(cols)
        kept = {(frozenset(x), a) for x, a in fds for _, cols in parts if x | {a} <= set(cols)}
        within = {(frozenset(k), c) for k, cols in parts for c in cols if c not in k} | kept
        assert all(a in fd.closure(x, within) for x, a in fds)  # every dependency follows from those inside parts


def test_cover_has_nothing_superfluous():
    fds = {(frozenset("a"), "b"), (frozenset("b"), "c"), (frozenset("a"), "c"), (frozenset("c"), "a")}
    cover = fd.minimal_cover(fds, list("abc"))
    for f in fds:
        assert f[1] in fd.closure(f[0], cover)
    for f in cover:
        assert f[1] not in fd.closure(f[0], [g for g in cover if g != f])


def test_null_and_repeated_keys_refuse_the_proof(spark):
    wide = spark.createDataFrame([(1, 10, "x"), (2, None, "y"), (3, 11, "z")], "line int, cust int, name string")
    parts = nf.decompose(wide, {"line": ["line", "cust"], "cust": ["cust", "name"]})
    order = [("line", []), ("cust", ["cust"])]
    assert [tuple(r) for r in nf.lossless_by_keys(parts, order).collect()] == [("cust", 3, 0, 1)]
    assert nf.lossless_check(wide, parts, order).count() == 1  # the join does lose the row
    ok = wide.filter("cust is not null")
    assert [tuple(r) for r in nf.lossless_by_keys(nf.decompose(ok, {"line": ["line", "cust"], "cust": ["cust", "name"]}), order).collect()] == [("cust", 2, 0, 0)]
    twice = wide.withColumn("cust", F.lit(10))
    assert [tuple(r) for r in nf.lossless_by_keys(nf.decompose(twice, {"line": ["line", "cust"], "cust": ["cust", "name"]}), order).collect()] == [("cust", 3, 1, 0)]


def test_parts_of_many_rows_are_dealt_over_tasks_in_proportion(spark):
    wide = spark.createDataFrame([(i, i % 7, None if i % 7 == 3 else "n%d" % (i % 7)) for i in range(3000)] * 2, "line int, cust int, name string").localCheckpoint()
    most, nf.ROWS_AT_ONCE = nf.ROWS_AT_ONCE, 100
    try:
        parts = nf.decompose(wide, {"line": ["line", "cust"], "cust": ["cust", "name"]}, {"line": ["line"]})
    finally:
        nf.ROWS_AT_ONCE = most
    held = parts["line"].groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) > 20 and max(r["count"] for r in held) < 250
    assert [tuple(nf.key_counts(parts["line"], k).first()) for k in (["line"], ["line", "cust"], ["cust"])] == [(3000, 0), (3000, 0), (3000, 2993)]
    assert tuple(nf.key_counts(parts["cust"], ["cust"]).first()) == (7, 0)
    assert tuple(nf.key_counts(parts["cust"].limit(0), ["cust"]).first()) == (0, 0)


def test_kept_rows_are_written_in_bounded_files(spark):
    kept = keep(spark.range(0, 1000, 1, 2), "few-to-a-file", 100)
    assert len(kept.inputFiles()) >= 10 and kept.count() == 1000


def test_inclusions_match_brute_force(spark):
    rnd = random.Random(4)
    values = {"a.x": [rnd.randrange(50) for _ in range(300)], "a.y": [rnd.randrange(20) for _ in range(300)], "b.k": list(range(50)) * 2, "b.m": [None] * 100,
              "c.z": [str(rnd.randrange(60)) for _ in range(40)], "c.w": [None, "3"] * 20}
    frame = lambda t, kind: spark.createDataFrame(list(zip(*(v for n, v in values.items() if n[0] == t))), ", ".join(f"{n[2]} {kind}" for n in values if n[0] == t))
    got = {(r.column, r.refers_to): (r.n_values, r.n_target) for r in fd.inclusions(
        {"a": (frame("a", "int"), ["x", "y"]), "b": (frame("b", "bigint"), ["k", "m"]), "c": (frame("c", "string"), ["z", "w"])}).collect()}
    sets = {n: {str(x) for x in v if x is not None} for n, v in values.items()}
    # A column without values refers to nothing.
    assert got == {(p, q): (len(sets[p]), len(sets[q])) for p in sets for q in sets if p != q and sets[p] and sets[p] <= sets[q]}
    assert ("a.y", "b.k") in got and ("c.w", "a.x") in got
