import hashlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerflow.llm import bottomk as bk
from tests.conftest import SF_MID
from tests.llm.helpers import empty_docs, odd_docs


def shingles(text, n=5):
    w = text.encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    """{id: (n, edited, next text)} in descending id."""
    out = {}
    order = sorted(docs, reverse=True)
    for i, d in enumerate(order):
        t, nxt = docs[d], docs[order[(i + 1) % len(order)]]
        h = len(t) // 2
        out[d] = (len(t), t[:len(t) - h] + nxt[:h], nxt)
    return out


def check(rows, docs):
    want = brute(docs)
    off = []
    for r in rows:
        n, edited, nxt = want[r.doc_id]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == bk.to_text(bk.sketch(docs[r.doc_id].encode()))
        assert r.edited_fingerprint == bk.to_text(bk.sketch(edited.encode()))
        off += [r.near_edited - jaccard(docs[r.doc_id], edited), r.near_next - jaccard(docs[r.doc_id], nxt)]
    assert len(rows) == len(docs)
    assert np.sqrt(np.mean(np.square(off))) < 0.05 and max(map(abs, off)) < 0.25


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    check(E.queries()["op3_bottomk"](spark, SF_MID).collect(), docs)


def test_chunks_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(bk, "CHUNK_BYTES", 1000)
    df = spark.range(300).select((F.col("id") * 7 + 3).alias("doc_id"),
                                 F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 40 + 1),
                                                              lambda x: (x * F.col("id") % 23).cast("string"))).alias("text"))
    docs = {r.doc_id: r.text for r in df.collect()}
    out = bk.compare_with_next(df)
    assert out.rdd.getNumPartitions() > 5
    check(out.collect(), docs)


def test_odd_rows(spark):
    df = odd_docs(spark)
    rows = bk.compare_with_next(df).collect()
    assert len(rows) == df.count()
    by = {}
    for r in df.collect():
        by.setdefault(r.doc_id, set()).add(r.text or "")
    for r in rows:
        assert r.n_chars in {len(t) for t in by[r.doc_id]}
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    one = df.filter("doc_id = 3").limit(1)
    (r,) = bk.compare_with_next(one).collect()
    assert r.near_next == 1.0


def test_empty_table(spark):
    assert bk.compare_with_next(empty_docs(spark)).collect() == []
    assert bk.sketches(empty_docs(spark)).collect() == []


def test_sketches_merge_to_the_sketch_of_the_whole(spark):
    rng = np.random.default_rng(1)
    parts = [" ".join(map(str, rng.integers(0, 50, 400))) for _ in range(30)]
    rows = [("hot" if i % 3 else "cold", p) for i, p in enumerate(parts)] + [(None, "a"), ("none", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, grp string, text string").repartition(7)
    parts_df = df.join(bk.sketches(df), "doc_id")
    got = {r.grp: r for r in bk.merge_sketches(parts_df, "grp").collect()}
    for g in ("hot", "cold"):
        every = [bk.shingle_hashes(p.encode().split()) for n, p in rows if n == g]
        whole = np.unique(np.concatenate(every))
        assert got[g].fingerprint == bk.to_text(whole[:bk.K])
        assert abs(got[g].n_distinct / len(whole) - 1) < 0.3
    assert got["none"].fingerprint == "" and set(got) == {"hot", "cold", "none", None}


def test_estimates():
    a = bk.sketch(b" ".join(b"%d" % i for i in range(2000)))
    b = bk.sketch(b" ".join(b"%d" % i for i in range(1000)))
    assert abs(bk.resemblance(a, b) - 0.5) < 0.15
    assert abs(bk.containment(b, a) - 1.0) < 0.25 and abs(bk.containment(a, b) - 0.5) < 0.2
    assert abs(bk.distinct_shingles(a) / 1996 - 1) < 0.3
    empty = bk.sketch(b"")
    assert bk.resemblance(empty, empty) == 1.0 and bk.resemblance(empty, a) == 0.0


def test_an_id_on_many_rows_is_cut_by_its_texts(spark, monkeypatch):
    """A third of the rows share an id, a third have none: chunks stay small
    and the order is that of one sort."""
    monkeypatch.setattr(bk, "CHUNK_BYTES", 800)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"w{i} " * (1 + i % 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = []
    at = type(df).repartitionById

    def watch(self, n, *cols):
        seen.extend(r["count"] for r in self.groupBy("_chunk").count().collect())
        return at(self, n, *cols)
    monkeypatch.setattr(type(df), "repartitionById", watch)
    got = bk.compare_with_next(df).collect()
    assert len(got) == 600 and max(seen) < 150 and len(seen) > 10
    order = [(r.doc_id, r.text) for r in df.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()).collect()]
    want = sorted((str(d), len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + order[(i + 1) % 600][1][:len(t) // 2]).encode()).hexdigest()) for i, (d, t) in enumerate(order))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
