import collections
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerflow.llm import pivotal
from tests.conftest import SF_MID
from tests.llm.helpers import empty_docs, odd_docs


def words(t):
    return len((t or "").encode().split())


def slow_targets(sizes):
    """Share by weight, cap at three times, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    excess = float(total)
    while excess > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += excess * weight[s] / w
        excess = 0.0
        for s in list(open_):
            if target[s] > 3 * sizes[s]:
                excess += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def check(rows, docs, within=None):
    """rows: (doc_id, size, source_size, target, taken); docs: (id, text, source)."""
    sizes = collections.defaultdict(int)
    for _, t, s in docs:
        sizes[s] += words(t)
    want = slow_targets(sizes)
    source = collections.defaultdict(list)
    for d, t, s in docs:
        source[(d, words(t))].append(s)
    taken = collections.Counter()
    assert collections.Counter((r.doc_id, r["size"]) for r in rows) == collections.Counter((d, words(t)) for d, t, _ in docs)
    for r in rows:
        s = next(s for s in source[(r.doc_id, r["size"])] if sizes[s] == r.source_size and abs(want[s] - r.target) < 1e-6 * max(1, want[s]))
        assert r["size"] == 0 and r.taken == 0 or r["size"] and r.taken % r["size"] == 0 and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s in sizes:
        most = max(words(t) for _, t, x in docs if x == s)
        assert abs(taken[s] - want[s]) <= (most if within is None else max(within * want[s], 0.51 * min((words(t) for _, t, x in docs if x == s and words(t)), default=0) + 1)), s
    return taken, want


def docs_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_query_meets_targets_and_reruns_agree(spark):
    docs = docs_of(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    rows = E.queries()["op9_pivotal"](spark, SF_MID).collect()
    check(rows, docs, within=0.02)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    again = E.queries()["op9_pivotal"](spark, SF_MID).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def mixed(df):
    x = df.select("doc_id", "source", pivotal.word_count().alias("words"), F.xxhash64("text").alias("text"))
    x = pivotal.mix_sized(x, "words", tie=["text"])
    return x.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                    (F.col("_copies") * F.col("_size")).alias("taken"))


def test_many_chunks_combine(spark, monkeypatch):
    monkeypatch.setattr(pivotal, "CHUNK_ROWS", 20)
    monkeypatch.setattr(pivotal, "FAN", 3)
    rng = random.Random(1)
    rows = [(i, "w " * int(rng.lognormvariate(3, 1.2)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mixed(df).collect(), rows, within=0.01)


def test_odd_rows(spark):
    df = odd_docs(spark)
    check(mixed(df).collect(), docs_of(df))
    out = pivotal.mix(df)
    assert out.columns[:len(df.columns)] == df.columns and out.count() == df.count()


def test_empty_table_and_no_words(spark):
    assert pivotal.mix(empty_docs(spark)).collect() == []
    both = odd_docs(spark).withColumn("_row", F.lit(1)).withColumn("_copies", F.lit("x"))
    out = pivotal.mix(both, copies_col="_copies")
    assert out.columns == [*both.columns, "_copies_"] and out.count() == both.count()
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " ", None)], "doc_id long, text string, source string")
    rows = mixed(df).collect()
    assert len(rows) == 3 and all(r.taken == 0 and r.target == 0.0 for r in rows)


def test_rows_without_an_id_spread_over_chunks_and_reruns_agree(spark, monkeypatch):
    """A third of the rows have no id, a third share one."""
    monkeypatch.setattr(pivotal, "CHUNK_ROWS", 50)
    rng = random.Random(2)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"t{i} " * rng.randint(1, 60), f"s{i % 4}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    chunks = pivotal.mix_sized(df.select("doc_id", "source", pivotal.word_count().alias("words")), "words")
    check(chunks.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                        (F.col("_copies") * F.col("_size")).alias("taken")).collect(), rows, within=0.02)
    one, other = (sorted((r.text, r["_copies"]) for r in pivotal.mix(df.repartition(n)).select("text", "_copies").collect()) for n in (1, 7))
    assert one == other


def test_targets_with_caps(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, "e": 70, None: 3000}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in pivotal.source_targets(df).collect()}
    want = slow_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes) and abs(sum(got.values()) - 4085) < 1e-6


share = st.floats(0.01, 0.99)


@settings(max_examples=300, deadline=None)
@given(share, st.integers(1, 50), share, st.integers(1, 50), st.floats(0, 0.999))
def test_pivot_keeps_words_and_settles_one(p, a, q, b, draw):
    x, y = pivotal.pivot(p, a, q, b, draw)
    assert abs(x * a + y * b - p * a - q * b) < 1e-9
    assert -1e-9 <= x <= 1 + 1e-9 and -1e-9 <= y <= 1 + 1e-9
    assert any(v in (0.0, 1.0) for v in (x, y))


@settings(max_examples=100, deadline=None)
@given(share, st.integers(1, 50), share, st.integers(1, 50))
def test_pivot_keeps_expectations(p, a, q, b):
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
    odds = down / (up + down)
    first, second = pivotal.pivot(p, a, q, b, 0.0), pivotal.pivot(p, a, q, b, 0.999999999)
    assert abs(odds * first[0] + (1 - odds) * second[0] - p) < 1e-6
    assert abs(odds * first[1] + (1 - odds) * second[1] - q) < 1e-6


def test_inclusion_follows_probabilities():
    """Over many draws a document is taken as often as its probability."""
    rng = np.random.default_rng(0)
    p = np.full(40, 0.3)
    a = rng.integers(64, 128, 40).astype(float)
    got = np.mean([pivotal._round_run(p, a, rng.integers(-2**62, 2**62, 40)) for _ in range(2000)], axis=0)
    assert np.abs(got - 0.3).max() < 0.06


@pytest.mark.parametrize("n", [1, 5, 20])
def test_settling_is_near(n):
    rng = np.random.default_rng(n)
    a = 2.0 ** np.arange(n) + rng.integers(0, 2, n)
    p = rng.random(n)
    z = pivotal._settle(p, a, None)
    assert set(z) <= {0.0, 1.0} and abs((z - p) @ a) <= 2.0
