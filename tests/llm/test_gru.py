import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerflow.llm import gru
from tests.conftest import SF_MID
from tests.llm.helpers import empty_docs, odd_docs, odd_texts


def words(t):
    return [w.decode() for w in (t or "").encode().lower().split()]


def trained(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0


def slow_base(docs):
    """[(tokens, known, N, base)] per document."""
    c = collections.Counter()
    for d, t in docs:
        if trained(d):
            c.update(words(t))
            c["\0end"] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for _, t in docs:
        w = [*words(t), "\0end"]
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def check(rows, docs):
    want = collections.defaultdict(list)
    for (d, t), x in zip(docs, slow_base(docs)):
        want[d].append(x)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (not trained(r.doc_id))
        assert any((r.n_tokens, r.n_known, r.train_tokens) == x[:3] and abs(r.base_score - x[3]) < 1e-6 * max(1, abs(x[3])) for x in want[r.doc_id])
        assert math.isfinite(r.score) and r.score < 0


def test_query_equals_brute_force_and_beats_the_base(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    rows = E.queries()["op2_gru"](spark, SF_MID).collect()
    check(rows, docs)
    held = [r for r in rows if r.held_out]
    per = lambda c, x: sum(r[c] for r in x) / sum(r.n_tokens for r in x)
    assert per("score", held) > per("base_score", held) + 0.1
    known = [r for r in rows if r.n_known == r.n_tokens and not r.held_out]
    assert per("score", known) > per("base_score", known)


def small_vocabulary():
    w = ["the", "and", "of", "that", "band", "rand", "xe", "ye", "solo"]
    c = np.array([50, 40, 30, 20, 9, 8, 3, 2, 1])
    kinds = {b"he": 50, b"nd": 57, b"at": 20}
    once = [0, 0, 0, 4]
    return gru.Vocabulary(w, c, list(kinds), np.array([*kinds.values(), 30 + 3 + 2 + 1 + 3]), np.array([1, 3, 1, 8]), np.array(once), 20, 189, 14)


@pytest.fixture
def net(monkeypatch):
    monkeypatch.setattr(gru, "MODEL_WORDS", 6)
    v = small_vocabulary()
    n = gru.Network(v)
    rng = np.random.default_rng(1)
    n.flat += rng.standard_normal(n.size).astype(np.float32) * 0.3
    return v, n


def test_probabilities_of_slots_sum_to_one(net):
    _, n = net
    h = np.random.default_rng(0).standard_normal((3, gru.HIDDEN)).astype(np.float32)
    total = sum(np.exp(n.outputs(h, np.full(3, s))[0]) for s in range(n.n_slots))
    assert np.allclose(total, 1, atol=1e-5)


def test_words_within_a_rest_sum_to_less_than_one(net):
    v, _ = net
    for k in range(1, len(v.rest)):
        inside = sum(10 ** v.within[i] for i, w in enumerate(v.words) if v.class_of(w.encode()) == k and v.slots[i] == v.rest[k])
        assert inside + v.unseen[k] <= 1 + 1e-9


def test_slots_follow_words_and_endings(net):
    v, _ = net
    texts = ["", " ", "the AND of", "The\tthat\x0bband  xe\n", "straße É é and\u00a0the x", "solo unseen he d at THAT", "éà 東京 👍"] + [t or "" for t in odd_texts()]
    index = {w: i for i, w in enumerate(v.words)}
    e = v.encode(pa.array(["before", *texts], pa.string()).slice(1))
    for i, t in enumerate(texts):
        want = [v.slots[index[w]] if w in index else v.rest[v.class_of(w.encode())] for w in words(t)]
        at = [index[w] for w in words(t) if w in index]
        assert e.of(i).tolist() == [*want, 0] and e.tails[i] == [w for w in words(t) if w not in index]
        assert e.known[i] == len(at) + 1 and math.isclose(e.base[i], v.base[at].sum() + v.base_end) and math.isclose(e.within[i], v.within[at].sum(), abs_tol=1e-12)
    assert v.encode(pa.array([], pa.string())).tails == [] and v.encode(pa.array([""])).of(0).tolist() == [0]


def test_other_endings_share_several_classes():
    v = gru.Vocabulary(["the", "of", "ox", "axe"], np.array([9, 8, 2, 1]), [b"he"], np.array([20, 20, 20, 20]), np.array([1, 2, 2, 1]), np.array([0, 0, 1, 0]), 4, 24, 7)
    assert v.others == 3 and v.class_of(b"the") == 1
    for w in (b"of", b"ox", b"axe", b"z", "\u00e9".encode()):
        assert v.class_of(w) == 2 + w[-1] % 3 == v.ending_class[int.from_bytes(w[-2:], "big")]


def test_scores_do_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id < 300")
    one, other = ({r.doc_id: (r.base_score, r.score) for r in gru.score_documents(x).collect()} for x in (df.coalesce(1), df.repartition(4)))
    assert one.keys() == other.keys()
    for d in one:
        assert np.allclose(one[d], other[d], rtol=1e-5)


def one_by_one(n, slots, start):
    """The model's log10 probability, a token at a time."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    soft = lambda x: np.log(np.exp(x - x.max()) / np.exp(x - x.max()).sum())
    h, total, last, d = np.zeros(gru.HIDDEN), 0.0, start, gru.HIDDEN
    f = {k: getattr(n, k).astype(float) for k in n.shapes}
    for s in slots:
        p, hu = f["emb"][last] @ f["w"] + f["b"], h @ f["u"]
        z, r = sig(p[:d] + hu[:d]), sig(p[d:2 * d] + hu[d:2 * d])
        cand = np.tanh(p[2 * d:] + r * hu[2 * d:])
        h = cand + z * (h - cand)
        k = n.slot_class[s]
        a, b = n.first[k], n.first[k + 1]
        total += soft(h @ f["wc"] + f["bc"])[k] + soft(f["ws"][a:b] @ h + f["bs"][a:b])[s - a]
        last = s
    return total / math.log(10)


def test_scores_of_whole_documents_equal_one_by_one(net, monkeypatch):
    monkeypatch.setattr(gru, "SCORE_LANES", 3)
    v, n = net
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, n.n_slots, k).astype(np.int32) for k in (1, 200, 3, 17, 16, 90, 1, 33)]
    got = gru.log10_of(n, docs, n.n_slots)
    assert np.allclose(got, [one_by_one(n, d, n.n_slots) for d in docs], rtol=1e-4)
    assert len(gru.log10_of(n, [], n.n_slots)) == 0


def test_gradient_equals_differences(net):
    _, n = net
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, n.n_slots + 1, (5, 4)), rng.integers(0, n.n_slots, (5, 4))
    fresh = np.zeros((5, 4), dtype=bool)
    fresh[0] = True
    fresh[2, 1] = True
    weight = np.ones((5, 4), dtype=np.float32)
    weight[4, 3] = 0
    h0 = np.zeros((4, gru.HIDDEN), dtype=np.float32)
    grad, _, _ = n.gradient(x, y, fresh, weight, h0)

    def loss():
        states, _ = n.recur(x, fresh, h0)
        live = weight.ravel() > 0
        return -n.outputs(states.reshape(-1, gru.HIDDEN)[live], y.ravel()[live])[0].mean()
    for i in rng.choice(n.size, 60, replace=False):
        old = n.flat[i]
        n.flat[i] = old + 3e-3
        up = loss()
        n.flat[i] = old - 3e-3
        down = loss()
        n.flat[i] = old
        assert abs((up - down) / 6e-3 - grad[i]) < 2e-3 + 0.05 * abs(grad[i])


def test_training_learns_an_order(monkeypatch):
    """Slots that alternate: a unigram can't know the next one."""
    monkeypatch.setattr(gru, "MODEL_WORDS", 6)
    v = small_vocabulary()
    n = gru.Network(v)
    a, b = int(v.slots[0]), int(v.slots[1])
    docs = [np.array([a, b] * 40 + [0], dtype=np.int32) for _ in range(3000)]
    before = gru.log10_of(n, docs[:1], n.n_slots)[0]
    tokens, _ = gru.train_on(n, iter(docs), n.n_slots)
    assert tokens == 3000 * 81
    assert gru.log10_of(n, docs[:1], n.n_slots)[0] > 0.5 * before


def test_words_beyond_the_dictionary_score_the_same(spark, monkeypatch):
    """The base score does not depend on how many words travel with tasks."""
    df = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id < 120")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    monkeypatch.setattr(gru, "DICTIONARY", 50)
    check(gru.score_documents(df).collect(), docs)


def test_odd_rows(spark):
    df = odd_docs(spark)
    check(gru.score_documents(df).collect(), [(r.doc_id, r.text) for r in df.collect()])
    held = spark.createDataFrame([(d, "a b") for d in range(200) if not trained(d)], "doc_id long, text string")
    check_rows = gru.score_documents(held).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 for r in check_rows)


def test_empty_table(spark):
    assert gru.score_documents(empty_docs(spark).withColumn("x", F.lit(1))).collect() == []


def test_the_network_has_its_full_size():
    """The 1,000 most frequent words have slots of their own, not a class's rest."""
    w = [f"w{i:04d}" for i in range(1200)]
    v = gru.Vocabulary(w, np.arange(1300, 100, -1), [], np.array([840_600]), np.array([1200]), np.array([0]), 10, 840_610, 1201)
    own = v.slots[:1000]
    assert len(set(own)) == 1000 and not set(own) & set(v.rest[1:])
    assert set(v.slots[1000:]) <= set(v.rest)
    n = gru.Network(v)
    assert n.emb.shape[1] == 12 and n.ws.shape[1] == 12
