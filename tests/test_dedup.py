import random

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerflow.operators import dedup
from ledgerflow.session import shuffles_freed
from tests import brute


def _random_strings(seed, n, alphabet="abc", max_len=9):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len))) for _ in range(n // 2)]
    out = list(base)
    while len(out) < n:  # near copies
        s = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            op = rnd.randint(0, 2)
            pos = rnd.randint(0, len(s))
            if op == 0:
                s.insert(pos, rnd.choice(alphabet))
            elif s and op == 1:
                del s[min(pos, len(s) - 1)]
            elif s:
                s[min(pos, len(s) - 1)] = rnd.choice(alphabet)
        out.append("".join(s))
    return out


def _want(texts, pairs, k, share):
    """Brute-force pairs of distinct texts, limited to the share of the
    shorter one, and the copies."""
    distinct = {}
    for i, t in texts.items():
        if t:
            distinct.setdefault(t, i)
    by_id = {i: t for t, i in distinct.items()}
    want = {(a, b): d for (a, b), d in pairs(by_id, k).items() if d <= int(share * min(len(by_id[a]), len(by_id[b])))}
    return want | {(distinct[t], i): 0 for i, t in texts.items() if t and distinct[t] != i}


def _check_pairs(spark, texts, k, share=0.6):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    rows = dedup.lev_pairs(df, "id", F.col("t"), k, share).collect()
    got = {(r.id_a, r.id_b): r.distance for r in rows}
    want = _want(dict(enumerate(texts)), brute.lev_pairs, k, share)
    assert got == want and len(rows) == len(want) and any(d > 0 for d in want.values())


def test_keys_keep_every_script(spark):
    df = spark.createDataFrame([(1, "数据工程的质量检查非常重要"), (2, "Проверка качества данных"), (3, "データ品質の確認"), (4, "!!! ---"), (5, "???"),
                                (6, "plain english text that is long enough"), (7, "Plain, English text: that is LONG enough!"),
                                (8, "数据工程的质量检查非常重要。"), (9, "数据工程的质量检查非常重大"), (10, "Élan vital"), (11, "elan  VITAL")], "id bigint, t string")
    got = {(r.id_a, r.id_b): r.distance for r in dedup.lev_pairs(df, "id", dedup.normalize_key("t"), 3).collect()}
    assert got == {(1, 8): 0, (1, 9): 1, (6, 7): 0, (10, 11): 0}


def test_substring_hashes_tell_substrings_apart():
    rnd = random.Random(4)
    text = "".join(rnd.choice("abé数") for _ in range(60))
    sub = dedup._Substrings(text)
    spans = [(i, n) for i in range(60) for n in range(1, 61 - i)]
    import numpy as np
    h = sub.hashes(np.array([i for i, _ in spans]), np.array([n for _, n in spans]))
    by_text, by_hash = {}, {}
    for (i, n), x in zip(spans, h):
        by_text.setdefault(text[i:i + n], set()).add(x)
        by_hash.setdefault((n, x), set()).add(text[i:i + n])
    assert all(len(v) == 1 for v in by_text.values()) and all(len(v) == 1 for v in by_hash.values())


def test_lev_pairs_matches_brute_force_k2(spark):
    _check_pairs(spark, _random_strings(1, 300, max_len=9), 2)


def test_lev_pairs_matches_brute_force_k3(spark):
    _check_pairs(spark, _random_strings(2, 250, alphabet="abcd", max_len=14), 3)


def test_lev_pairs_k1_longer(spark):
    _check_pairs(spark, _random_strings(3, 200, alphabet="ab", max_len=20), 1)


def _templated(n: int, seed: int = 8) -> list[str]:
    """Texts of one template with two slots of random words; every tenth text
    is a near copy of the one before."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24))
    out = []
    for i in range(n):
        if i % 10 == 9:
            out.append(out[-1][:40] + "#" + out[-1][41:])
        else:
            out.append(f"dear customer your order for {word()} has left our house and will reach {word()} within the next five working days")
    return out


def test_texts_of_one_template_match_brute_force(spark):
    _check_pairs(spark, _templated(120) + _random_strings(6, 60, max_len=30), 3, share=0.25)


def test_texts_of_one_template_make_few_candidates(spark):
    found = []
    for n in (200, 400, 800):
        texts = _templated(n)
        df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").select("id", "t", F.length("t").alias("len"))
        cand = dedup._candidates(df, 12, dedup.EDIT_SHARE).distinct()
        assert cand.filter("least(rid, sid) % 10 = 8 and abs(rid - sid) = 1").selectExpr("least(rid, sid)").distinct().count() == n // 10
        found.append(cand.count())
    # In proportion to the true pairs: without the finer cuts, n * (n - 1) of them.
    assert found[-1] <= 3 * 800 // 10 and found[2] <= 6 * found[0], found


def test_finer_cuts_match_brute_force_at_every_group_size(spark):
    texts = _random_strings(11, 160, alphabet="ab", max_len=24)
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    want = _want(dict(enumerate(texts)), brute.lev_pairs, 4, 0.5)
    for hot in (0, 1, 3):
        got = {(r.id_a, r.id_b): r.distance for r in dedup.lev_pairs(df, "id", F.col("t"), 4, 0.5, hot_segment=hot).collect()}
        assert got == want


def test_keys_leave_a_task_in_bounded_batches():
    # One Arrow batch of 300 texts, some 600 probes each.
    texts = _templated(300)
    probes = dedup._Cut(3, 0.25, True).probes
    batch = pa.record_batch([pa.array(range(300), pa.int64()), pa.array(texts)], names=["id", "t"])
    got = list(dedup._key_batches([batch], probes, "sid", at_once=2000))
    each = [len(probes(t)[0]) for t in texts]
    assert max(b.num_rows for b in got) < 2000 + max(each) < sum(each) / 10
    ids = [x for b in got for x in b.column(3).to_pylist()]
    assert ids == [x for x, n in enumerate(each) for _ in range(n)]


def test_sketches_never_ask_for_more_edits_than_were_made(spark):
    rng = random.Random(5)
    alphabet = "abcdefghij klmnop\u00e9\u6771\U0001f600"
    rows = []
    for _ in range(300):
        a = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400)))
        b, edits = list(a), rng.randrange(0, 13)
        for _ in range(edits):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.choice(alphabet)] * rng.randrange(2)
        rows.append((edits, *dedup._sketch(a).tolist(), *dedup._sketch("".join(b)).tolist()))
    apart = dedup._counts_apart(F.col("c0"), F.col("d0")) + dedup._counts_apart(F.col("c1"), F.col("d1"))
    got = spark.createDataFrame(rows, "edits int, c0 long, c1 long, d0 long, d1 long").select("*", apart.alias("apart")).collect()
    nibbles = lambda x: [x >> s & 15 for s in range(0, 64, 4)]
    for r in got:
        assert r.apart == sum(min((x - y) % 16, (y - x) % 16) for c, d in ((r.c0, r.d0), (r.c1, r.d1)) for x, y in zip(nibbles(c), nibbles(d)))
        assert r.apart <= 2 * r.edits


def test_texts_that_share_a_passage_alone_are_no_candidates(spark):
    # Eight texts to a passage, so that its segments stay below HOT_SEGMENT; a near copy of every eighth.
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = []
    for _ in range(20):
        passage = text(200)
        group = [(b := text(300))[:(cut := rng.randrange(100, 103))] + passage + b[cut:] for _ in range(7)]
        texts += [*group, group[0][:50] + "#" + group[0][51:]]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").select("id", "t", F.length("t").alias("len"))
    cand = {tuple(sorted((r.rid, r.sid))) for r in dedup._candidates(df, 12, dedup.EDIT_SHARE).collect()}
    assert cand == {(i, i + 7) for i in range(0, 160, 8)}


def test_rounds_of_verifications_find_the_same_and_leave_no_shuffle_files(spark):
    texts = [("x" * i + "0123456789" * 6)[:60] + c for c in "abc" for i in range(6)] + _random_strings(13, 60, max_len=40)
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string").select("id", "t", F.length("t").alias("len"))
    pairs = spark.createDataFrame([(i, j, min(len(texts[i]), len(texts[j]))) for i in range(40) for j in range(i + 1, 40) if texts[i] and texts[j]], "a bigint, b bigint, l int")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before = files().size()
    with shuffles_freed(spark):
        found = [dedup._verified(pairs, df, 3, 0.25, round_chars=n) for n in (1 << 20, 1)]
    assert files().size() <= before + 4
    one, many = ({tuple(r) for r in f.collect()} for f in found)
    want = _want({i: t for i, t in enumerate(texts[:40])}, brute.lev_pairs, 3, 0.25)
    assert one == many == {(a, b, d) for (a, b), d in want.items() if texts[a] != texts[b]} | {r for r in one if r[2] == 0}


def test_probes_that_no_index_has_are_dropped_before_the_shuffle(spark):
    cut = dedup._Cut(3, 0.25, False)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghij") for _ in range(60)) for _ in range(400)]
    texts += [t[:30] + "z" + t[31:] for t in texts[:20]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    index = dedup._keys(df, cut.index, "rid").localCheckpoint()
    every = dedup._keys(df, cut.probes, "sid")
    some = dedup._keys(df, cut.probes, "sid", dedup._Filter(index))
    on = ["l", "i", "h"]
    found = [sorted(tuple(r) for r in index.join(p, on).select("rid", "sid", "i").collect()) for p in (every, some)]
    assert found[0] == found[1] and len(found[0]) > len(texts) * 4
    assert some.count() < 1.5 * every.join(index.select(on).distinct(), on, "left_semi").count() < every.count() / 3


def test_components_match_union_find(spark):
    rnd = random.Random(5)
    nodes = list(range(400))
    # a long chain (diameter 150) plus random edges
    edges = [(i, i + 1) for i in range(150)] + [(rnd.randrange(400), rnd.randrange(400)) for _ in range(120)]
    e = spark.createDataFrame(edges, "u bigint, v bigint")
    n = spark.createDataFrame([(x,) for x in nodes], "node bigint")
    got = {r.node: r.cluster for r in dedup.components(e, n).collect()}
    assert got == brute.components(nodes, edges)


def test_components_leave_no_shuffle_files(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(0, 70)], "u long, v long")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before = files().size()
    labels = dedup.components(e)
    # What the counts of a round shuffle, an index and a data file for a task, and no round's edges.
    assert files().size() <= before + 40
    assert {r.cluster for r in labels.collect()} == {0}


def test_exact_dups_and_survivor(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c"), (4, " a\tb "), (5, "d")], "id bigint, t string")
    got = {r.id: (r.canonical_id, r.n_copies) for r in dedup.exact_dups(df, "id", dedup.normalize_ws("t")).collect()}
    assert got == {1: (1, 3), 2: (1, 3), 4: (1, 3)}


def test_documents_k12_match_brute_force(spark):
    """Whole normalised texts of the sf0.001 documents, k=12."""
    from ledgerflow.plans.q_dedup import LEV_K_WIDE
    from ledgerflow.sources.tables import load
    from tests.conftest import SF_SMALL
    d = load(spark, SF_SMALL, "documents")
    got = {(r.id_a, r.id_b): r.distance
           for r in dd_pairs(d, LEV_K_WIDE).collect()}
    norm = {r.doc_id: r.t for r in d.select("doc_id", dedup.normalize_key("text").alias("t")).collect()}
    assert got == _want(dict(sorted(norm.items())), brute.lev_pairs_banded, LEV_K_WIDE, dedup.EDIT_SHARE)


def dd_pairs(d, k):
    return dedup.lev_pairs(d, "doc_id", dedup.normalize_key("text"), k)


def test_banded_reference_agrees_with_full_dp():
    import random
    rnd = random.Random(9)
    for _ in range(3000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))
        k = rnd.randint(0, 5)
        d = brute.levenshtein(a, b)
        assert brute.levenshtein_within(a, b, k) == (d if d <= k else k + 1)
