import numpy as np

import __spark_entry__ as E
from ledgerflow.llm import pstable
from tests.conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, cosine=0.9):
    """{id: linked ids} over all pairs of valid vectors."""
    ids = [i for i, v in vectors.items() if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    m = np.array([vectors[i] for i in ids], dtype=float).reshape(len(ids), -1)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= cosine
    np.fill_diagonal(near, False)
    out = {i: set() for i in vectors}
    for a, row in enumerate(near):
        out[ids[a]] = {ids[b] for b in np.flatnonzero(row)}
    return out


def groups(links):
    low = {}
    for i in sorted(links):
        if i in low:
            continue
        todo = [i]
        low[i] = i
        while todo:
            for j in links[todo.pop()]:
                if j not in low:
                    low[j] = i
                    todo.append(j)
    return low


def check(rows, links, recall=0.9):
    found, all_links = sum(r.n_links for r in rows), sum(map(len, links.values()))
    low = groups(links)
    assert len(rows) == len(links) and found >= recall * all_links
    for r in rows:
        assert r.n_links <= len(links[r.vec_id]) and low[r.component_id] == low[r.vec_id] and r.component_id <= r.vec_id
        assert r.kept == (r.vec_id == r.component_id)
        assert (r.n_links > 0) == (r.component_id != r.vec_id or any(x.component_id == r.vec_id for x in rows if x.vec_id != r.vec_id))
    return found / max(all_links, 1)


def test_query_equals_brute_force(spark):
    vectors = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()}
    rows = E.queries()["op5_pstable"](spark, SF_MID).collect()
    check(rows, brute(vectors))


def spread(rng, centre, n, cosine):
    """Vectors at a given cosine to ``centre``."""
    noise = rng.standard_normal((n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * centre + np.sqrt(1 - cosine ** 2) * noise


def test_recall_at_the_threshold_and_no_false_link(spark):
    rng = np.random.default_rng(2)
    vectors = {}
    for k in range(400):  # pairs barely above the threshold
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        vectors[2 * k] = a
        vectors[2 * k + 1] = spread(rng, a, 1, 0.902)[0]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int")
    assert check(pstable.near_duplicates(df).collect(), brute(vectors)) >= 0.9


def test_hot_group_is_split_and_counted_once(spark):
    rng = np.random.default_rng(3)
    c = rng.standard_normal(32)
    c /= np.linalg.norm(c)
    near = spread(rng, c, 300, 0.99)
    vectors = {i: v for i, v in enumerate(near)} | {1000 + i: near[0] for i in range(50)} | {2000 + i: v for i, v in enumerate(rng.standard_normal((200, 32)))}
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    small = pstable.near_duplicates(df, block=64).collect()
    check(small, brute(vectors), recall=0.99)
    whole = pstable.near_duplicates(df).collect()
    assert {r.vec_id: tuple(r) for r in small} == {r.vec_id: tuple(r) for r in whole}


def test_odd_vectors(spark):
    good = [1.0, 2.0, 3.0]
    rows = [(1, good, 0), (2, good, 0), (3, [2.0, 4.0, 6.0], None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 3.0], 0),
            (7, [1.0, float("nan"), 1.0], 0), (8, [float("inf"), 1.0, 1.0], 0), (9, [], 0), (10, [1.0, 2.0], 0), (2, good, 0), (None, good, 0), (None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS cls", "'x' AS n", "'x' AS vec", "'x' AS first")
    out = pstable.near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.vec_id, []).append(r)
    assert {r.n_links for i in (1, 2, 3) for r in by[i]} == {4} and {r.component_id for i in (1, 2, 3) for r in by[i]} == {1}
    for i in (4, 5, 6, 7, 8, 9, 10):
        (r,) = by[i]
        assert (r.n_links, r.component_id, r.kept) == (0, i, True)
    assert sorted((r.n_links, r.component_id, r.kept) for r in by[None] if r.component_id is not None) == [(4, 1, False)]


def test_empty_table(spark):
    assert pstable.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_buckets_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    h = pstable.hasher(64)
    whole = h.buckets(x)
    assert all((h.buckets(x[i:i + 7]) == whole[i:i + 7]).all() for i in range(0, 500, 7))
