import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerflow.llm import collocations as C

from .helpers import empty_docs, odd_docs

FIELDS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows: list[tuple], max_words: int = 3, min_count: int = 10, limit: int = 2000) -> list[tuple]:
    """(lang, text) rows, by plain counting of every phrase."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, max_words + 1):
                counts.update((lang, *words[i:i + m]) for i in range(len(words) - m + 1))
    cand = {k: n for k, n in counts.items() if n >= min_count and len(k) > 2}
    best: dict[str, list] = {}
    for k, a in cand.items():
        lang, words = k[0], k[1:]
        inside = any(100 * f >= 50 * a for o, f in cand.items()
                     if o[0] == lang and len(o) > len(k) and any(o[i:i + len(words)] == words for i in range(1, len(o) - len(words) + 1)))
        if inside:
            continue
        cuts = [(1000000 * a * a // (counts[lang, *words[:j]] * counts[lang, *words[j:]]), j) for j in range(1, len(words))]
        score, j = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, *words[:j]], counts[lang, *words[j:]]))
    return sorted((lang, i, p.decode(), -a, l, r, totals[lang], -s)
                  for lang, found in best.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:limit], 1))


def as_rows(df) -> list[tuple]:
    return sorted(tuple(r[f] for f in FIELDS) for r in df.collect())


def prose(rng: random.Random, n: int) -> list[tuple]:
    words = ["alpha", "Beta", "gamma", "δέλτα", "東京", "x1", "it's", "a b", "#", "\x00z"]
    cuts = [" ", " ", " ", "  ", "\t", ", ", ".\n", "!", "\x0b"]
    return [(rng.choice(["en", "fr", None, "und", ""]), "".join(rng.choice(words) + rng.choice(cuts) for _ in range(rng.randrange(0, 60)))) for _ in range(n)]


def test_double_array_holds_exactly_its_rows():
    rng = np.random.default_rng(1)
    for n, depth, wide in ((1, 1, 4), (300, 3, 9), (5000, 4, C.DIGIT), (4000, 2, C.DIGIT)):
        rows = np.unique(rng.integers(1, wide + 1, (n, depth)), axis=0)
        base, check, ends = C.double_array(rows)
        probes = np.concatenate([rows, rng.integers(1, wide + 1, (3000, depth))])
        s = np.full(len(probes), C.ROOT)
        for d in range(depth):
            t = np.where(s >= 0, base[np.maximum(s, 0)] + probes[:, d], 0)
            s = np.where((s >= 0) & (check[t] == s), t, -1)
        known = {tuple(r): e for r, e in zip(rows.tolist(), ends.tolist())}
        assert [known.get(tuple(p), -1) for p in probes.tolist()] == s.tolist()
        assert len(set(ends.tolist())) == len(rows)


def test_equals_brute_force_in_one_and_in_many_shards(spark):
    rows = prose(random.Random(2), 400) + [("en", "one group of copies, one group of copies.")] * 300 + [(None, None), ("en", "")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for c in ("n", "num", "phrase", "w", "m", "f", "rank", "shard"):
        df = df.withColumn(c, df["lang"])
    expected = brute(rows)
    assert len(expected) > 50
    assert as_rows(C.collocations(df)) == expected
    # Tries of some 20 phrases, two at a time: many scans, candidates over several tries.
    assert as_rows(C.collocations(df, shard=20, at_once=2)) == expected


def test_longer_phrases_and_limit(spark):
    rows = prose(random.Random(4), 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert as_rows(C.collocations(df, max_words=4, min_count=4, limit=7)) == brute(rows, 4, 4, 7)


def test_small_blocks_count_alike(spark, monkeypatch):
    rows = prose(random.Random(6), 150)
    got = list(C.blocks(iter(spark.createDataFrame(rows, "lang string, text string").selectExpr("coalesce(lang, 'und') lang", "text").toArrow().to_batches(20)), 200))
    n = Counter()
    for lang, codes, words in got:
        assert codes[0] == codes[-1] == 0
        n.update((lang, words[int(c)].as_py()) for c in codes if c)
    assert sum(n.values()) == sum(t[6] for t in {r[0]: r for r in brute(rows, 2, 1)}.values())


def test_tokens_in_arrow_equal_tokens_of_each_text():
    rng = random.Random(7)
    texts = [t or "" for _, t in prose(rng, 60)] + ["", " ", ".", "A.B", "\tx  Y\r\n", "é東\u00a0z"]
    array = pa.array(["before"] + texts, pa.string()).slice(1)
    assert C.all_tokens(array).to_pylist() == [w for t in texts for w in (C.BREAK, *C.tokens(t.encode()))]
    assert C.all_tokens(pa.array([], pa.string())).to_pylist() == []


def test_score_is_exact_beyond_64_bits(spark):
    expr = "(cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) * cast(1000000 as decimal(7,0))) div (cast({l} as decimal(16,0)) * cast({r} as decimal(16,0)))"
    for a, l, r in ((3_037_000_503, 9_223_372_036, 5_000_000_007), (10 ** 15 + 7, 10 ** 15 + 9, 10 ** 16 - 1), (10 ** 16 - 1,) * 3):
        assert spark.sql("select " + expr.format(a=a, l=l, r=r)).collect()[0][0] == 1000000 * a * a // (l * r)


def test_odd_and_empty_tables(spark):
    rows = [(r["lang"], r["text"]) for r in odd_docs(spark, extra=False).collect()]
    assert as_rows(C.collocations(odd_docs(spark))) == brute(rows)
    assert C.collocations(empty_docs(spark)).collect() == []


def test_one_scan_a_level_however_many_tries(spark, monkeypatch):
    rows = prose(random.Random(8), 150)
    scans = []
    monkeypatch.setattr(C, "scan", lambda *a, scan=C.scan, **b: scans.append(a) or scan(*a, **b))
    monkeypatch.setattr(C, "BLOCK", 500)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert as_rows(C.collocations(df, shard=20, at_once=1)) == brute(rows)
    assert len(scans) == 2  # phrases of one word, and of two


def test_a_position_takes_part_in_one_trie(spark):
    rows = [("en", f"w{i} {x}") for i in range(40) for x in "xyz"]
    level = spark.createDataFrame(rows, "lang string, phrase string").withColumn("num", C.F.monotonically_increasing_id())
    begins = [{w for w in C.read_trie(t).word_list() if w.startswith(b"w")} for t in C.tries(level, 120, 15, "t").collect()]
    assert len(begins) > 1 and sum(map(len, begins)) == len(set().union(*begins)) == 40
