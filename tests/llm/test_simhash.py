import collections
import random

import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerflow.llm import simhash
from tests.conftest import SF_MID
from tests.llm.helpers import empty_docs, odd_docs


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(fps, bits=2):
    """{row: smallest id} by all pairs of distinct fingerprints."""
    distinct = sorted(set(fps.values()))
    up = {f: f for f in distinct}

    def root(f):
        while up[f] != f:
            up[f] = up[up[f]]
            f = up[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                up[root(a)] = root(b)
    low = {}
    for d, f in fps.items():
        low[root(f)] = min(low.get(root(f), d), d)
    return {d: low[root(f)] for d, f in fps.items()}


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    fps = {d: slow_fingerprint(t) for d, t in docs.items()}
    want = slow_groups(fps)
    got = E.queries()["op8_simhash"](spark, SF_MID).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {d: (fps[d], want[d]) for d in docs}
    assert len(got) == len(docs) and all(len(r.fingerprint) == 16 for r in got)


def links_of(spark, fps):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    rows = simhash.fingerprint_links(df).collect()
    return [(r.u % (1 << 64), r.v % (1 << 64)) for r in rows]


def same_groups(fps, links):
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f
    for u, v in links:
        up[root(u)] = root(v)
    got = collections.defaultdict(set)
    for f in fps:
        got[root(f)].add(f)
    want = collections.defaultdict(set)
    for f, g in slow_groups({f: f for f in fps}).items():
        want[g].add(f)
    return sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_links_keep_groups_of_random_and_hot_fingerprints(spark):
    rng = random.Random(3)
    hot = rng.getrandbits(64)
    fps = {hot}
    while len(fps) < 700:  # near copies: lists far above PAIRED
        f = hot
        for _ in range(rng.randint(0, 4)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:200]:
        fps.add(f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    fps = sorted(fps)
    links = links_of(spark, fps)
    assert same_groups(fps, links)
    assert len(links) < 20 * 28 * len(fps)


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd_docs(spark)).collect()
    texts = [r.text for r in odd_docs(spark).collect()]
    assert len(rows) == len(texts)
    by = collections.defaultdict(set)
    for r in rows:
        by[r.fingerprint].add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {0} and None in {r.doc_id for r in zero}
    assert sorted(r.fingerprint for r in rows) == sorted(f"{slow_fingerprint(t):016x}" for t in texts)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []


def test_only_null_ids_have_null_component(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(df).collect()] == [None, None]
    assert simhash.near_duplicates(df.withColumn("doc_id", F.lit(4))).select("component_id").distinct().collect()[0][0] == 4
