import math
import random
import re
from collections import Counter

import pytest

from ledgerflow.llm import divergence as D
from ledgerflow.llm import queries

from ..conftest import SF_MID, SF_SMALL
from .helpers import DOCS, empty_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def class_of(c: str) -> str:
    if c in " \t":
        return "blank"
    if c in "\n\x0b\x0c\r":
        return "line"
    if c in ".,;:?'\"()-":
        return "stop"
    if "a" <= c <= "z" or "A" <= c <= "Z" or "0" <= c <= "9":
        return "lower" if c > "Z" else "upper" if c > "9" else "digit"
    if c < " " or c == "\x7f":
        return "control"
    return "sign" if c < "\x7f" else "latin" if "À" <= c < "ʀ" else "other"


def js(p: dict, q: dict) -> float:
    p, q = ({k: v / sum(x.values()) for k, v in x.items()} for x in (p, q))
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
    kl = lambda a: sum(v * math.log2(v / m[k]) for k, v in a.items() if v)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def brute_kept(rows: list[tuple]) -> list[tuple]:
    """(id, base..., kept, class distance, word distance) of (id, lang, text) rows."""
    def split(text):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in re.split(r"[.,;:!?\x09-\x0D\x20]", folded) if w]
    classes, words = {}, {}
    for _, lang, text in rows:
        c = Counter(map(class_of, text or ""))
        if sum(c.values()) >= D.CLASS_GUARD:
            for k, v in c.items():
                classes.setdefault(lang or "und", Counter())[k] += v / sum(c.values())
        words.setdefault(lang or "und", Counter()).update(split(text))
    out = []
    for i, lang, text in rows:
        base = brute_base(text)
        lang = lang or "und"
        mine, ref = Counter(map(class_of, text or "")), classes.get(lang) or sum(classes.values(), Counter())
        by_class = js(mine, ref) if sum(mine.values()) >= D.CLASS_GUARD else None
        counted = words[lang] if lang in classes else sum(words.values(), Counter())
        common = [w for w, _ in sorted(counted.items(), key=lambda x: (-x[1], x[0].encode()))[:D.COMMON]]
        w = split(text)
        bins = lambda n: {k: n[k] for k in common} | {None: sum(n.values()) - sum(n[k] for k in common)}
        by_word = js(bins(Counter(w)), bins(counted)) if len(w) >= D.WORD_GUARD else None
        ok = (by_class is None or by_class <= D.MAX_CLASSES) and (by_word is None or by_word <= D.MAX_WORDS + D.WORD_SLACK / len(w) ** .5)
        out.append((i, *base, not base[-1] and ok, by_class, by_word))
    return out


FIELDS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]


def same(df, rows) -> None:
    rank = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[:6])
    got = sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=rank)
    want = sorted(brute_kept(rows), key=rank)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:8] == b[:8]
        assert a[8:] == pytest.approx(b[8:], abs=1e-9)


def test_odd_and_empty_tables(spark):
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in odd_docs(spark, extra=False).collect()]
    same(D.judge_documents(odd_docs(spark)), rows)
    assert D.judge_documents(empty_docs(spark)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text").collect()]
    same(queries.QUERIES["op11_divergence"](spark, SF_SMALL), rows)


def test_repeats_lines_and_symbols():
    for text in ["a b c a b c", "a a a a", "x y\nx y\n\n \nx y ", "a b c d", "", "# $ <|> é東👍", "one two"]:
        assert (*D.base_counts(text.encode()), D.base_failed(*[D.base_counts(text.encode())[i] for i in (0, 4)])) == brute_base(text)


def test_junk_goes_and_clean_texts_stay(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = queries.QUERIES["op11_divergence"](spark, SF_MID).join(labels, "doc_id").collect()
    judged = [r for r in got if not r["base_failed"]]
    clean, junk = [r for r in judged if r["quality"] == 1], [r for r in judged if r["quality"] == 0]
    assert all(r["kept"] for r in clean) and len(clean) > 200
    assert sum(r["kept"] for r in junk) <= 0.1 * len(junk) and len(junk) > 15


def test_a_hot_group_of_copies_leaves_others_kept(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id")
    rows = [(r["doc_id"], r["text"], r["lang"], None, None) for r in docs.filter("quality = 1 and lang = 'en'").collect()]
    hot = next(r for r in rows if 100 < len(r[1].split()) < 300)
    df = spark.createDataFrame(rows + [hot] * (len(rows) // 2), DOCS)
    assert D.judge_documents(df).filter("not kept and not base_failed").count() == 0


def test_languages_beyond_the_limit_use_the_reference_of_all(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice("the of and to in word other".split()) + rng.choice("abcdefgh") for _ in range(120))
    df = spark.createDataFrame([(i, text(), f"l{i % 4}", None, None) for i in range(40)], DOCS)
    refs = D.references(df, langs=2)
    assert set(refs) == {"l0", "l1", None} and all(len(r.words) <= D.COMMON for r in refs.values())
