"""Quality rules: distribution divergence from language references.

Base rules. ``n_words`` (``[^\\x20\\x09-\\x0D]+``), ``word_chars`` (code points
in words), ``n_symbols`` (``#*$%&|<>``), ``n_dup_lines`` (lines with a word
that equal an earlier line), ``n_repeat_words`` (words in windows of three
that occur twice or more in the text). A text of fewer than 50 words, or with
more than half its words in repeated windows, fails.

Divergence. A text has two histograms: code points over character classes
(``CLASSES``) and words over its language's ``COMMON`` most frequent words and
one bin for all others (words as the phrase operator cuts them: A-Z folded,
without punctuation). A language's reference is the mean of its texts' class
shares, each text with the same weight, and its words' shares over all texts.
The measure is the Jensen-Shannon distance (base 2, from 0 to 1). A text is
dropped beyond ``MAX_CLASSES`` or ``MAX_WORDS``. Guards: a histogram of few
entries is far from any reference by chance, so the class check needs
``CLASS_GUARD`` code points, the word check ``WORD_GUARD`` words, and its limit
is wider for short texts by ``WORD_SLACK`` / sqrt(words).

References are learnt from all texts: tasks add up their own class shares and
word counts, which then are shuffled by (language, word). Only
the ``LANGS`` languages with the most texts have a reference, so what tasks receive is
bounded; texts of other languages are compared with the reference of all.

Nulls and odd rows: a null text is the empty text, has no words and fails; a null
language counts as ``und``; ids are passed on, null or repeated; one row per
input row; an empty table gives no rows. Ties among common words go to the first in byte order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .collocations import BREAK, NO_LANG, texts_by_lang, tokens, word_counts
from .common import binary_column, stored, text_or_empty

MIN_WORDS = 50
REPEAT_PERCENT = 50
COMMON = 50
LANGS = 1000
MAX_CLASSES, CLASS_GUARD = 0.32, 200
MAX_WORDS, WORD_SLACK, WORD_GUARD = 0.2, 2.5, 50

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "sign", "control", "latin", "other")


def _class_table() -> np.ndarray:
    """Class of the code point that a byte begins; continuation bytes have none (the last number)."""
    t = np.full(256, CLASSES.index("other"), np.int64)
    t[:128] = CLASSES.index("sign")
    t[:32] = t[127] = CLASSES.index("control")
    for name, chars in (("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))), ("digit", b"0123456789"), ("blank", b" \t"),
                        ("line", b"\n\x0b\x0c\r"), ("stop", b".,;:?'\"()-")):
        t[list(chars)] = CLASSES.index(name)
    t[0xC3:0xCA] = CLASSES.index("latin")  # U+00C0 to U+027F
    t[0x80:0xC0] = len(CLASSES)
    return t


TABLE = _class_table()
_SPACES, _SYMBOLS = np.zeros(256, bool), np.zeros(256, bool)
_SPACES[list(SPACE)] = True
_SYMBOLS[list(SYMBOLS)] = True


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(TABLE[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[:len(CLASSES)]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    n = Counter(windows)
    if len(n) == len(windows):
        return 0
    twice = np.fromiter((n[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words), bool)
    for j in range(3):
        inside[j:j + len(windows)] |= twice
    return int(inside.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = text.split()
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(by_byte.sum() - by_byte[0x80:0xC0].sum() - by_byte[_SPACES].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, int(by_byte[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(words)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > REPEAT_PERCENT * n_words


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms of any scale."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(a: np.ndarray) -> float:
        some = a > 0
        return float((a[some] * np.log2(a[some] / m[some])).sum())
    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


class Reference(NamedTuple):
    classes: np.ndarray
    words: dict[bytes, int]  # common words and their bins; the last bin has all others
    shares: np.ndarray


def _class_shares(texts: DataFrame) -> DataFrame:
    """(lang, texts, class shares added up) per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), binary_column(b, "text")):
                n = class_counts(text)
                total = n.sum()
                if total >= CLASS_GUARD:
                    s = sums.setdefault(lang, np.zeros(len(CLASSES) + 1))
                    s[1:] += n / total
                    s[0] += 1
        yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], names=["lang", "sums"])
    return texts.mapInArrow(run, "lang string, sums array<double>")


def references(docs: DataFrame, common: int = COMMON, langs: int = LANGS, text_col: str = "text", lang_col: str = "lang") -> dict[str | None, Reference]:
    """References by language; None is the one of all texts. At most
    ``langs`` + 1 of them, of ``common`` words each."""
    texts = texts_by_lang(docs, text_col, lang_col)
    each = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(len(CLASSES) + 1)]
    shares = stored(_class_shares(texts).groupBy("lang").agg(*each), "class-shares")
    top = shares.orderBy(F.col("s0").desc(), "lang").limit(langs)
    classes = {r["lang"]: np.array(r[2:]) for r in top.collect()}  # langs rows
    every = shares.agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(1, len(CLASSES) + 1)]).collect()[0]
    if every[0] is None:
        return {}
    counts = stored(word_counts(texts), "word-counts")
    in_top = counts.filter("word is not null").join(F.broadcast(top.select("lang")), "lang")  # langs rows
    best = in_top.withColumn("o", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))).filter(F.col("o") <= common)
    overall = counts.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "word").limit(common)
    rows = [(r["lang"], r["word"], r["n"]) for r in best.select("lang", "word", "n").collect()]  # langs * common rows
    rows += [(None, r["word"], r["n"]) for r in overall.collect()]
    totals = {r["lang"]: r["n"] for r in counts.filter("word is null").join(F.broadcast(top.select("lang")), "lang").select("lang", "n").collect()}
    totals[None] = counts.filter("word is null").agg(F.sum("n").alias("n")).collect()[0]["n"]
    of_lang: dict[str | None, list] = {}
    for lang, w, n in rows:
        of_lang.setdefault(lang, []).append((w, n))
    out = {}
    for lang, c in [*classes.items(), (None, np.array(every))]:
        mine = sorted(of_lang.get(lang, ()), key=lambda x: (-x[1], x[0]))
        bins = np.array([*(n for _, n in mine), max(0, (totals.get(lang) or 0) - sum(n for _, n in mine))], float)
        out[lang] = Reference(c, {w.encode(): i for i, (w, _) in enumerate(mine)}, bins)
    return out


def divergence(text: bytes, ref: Reference) -> tuple[float | None, float | None, int]:
    """(class distance, word distance, words counted); None where a guard holds."""
    n = class_counts(text)
    by_class = distance(n.astype(float), ref.classes) if n.sum() >= CLASS_GUARD else None
    words = Counter(tokens(text))
    words.pop(BREAK, None)
    total = sum(words.values())
    if total < WORD_GUARD or not ref.words or not ref.shares.sum():
        return by_class, None, total
    bins = np.zeros(len(ref.shares))
    for w, i in ref.words.items():
        bins[i] = words.get(w, 0)
    bins[-1] = total - bins.sum()
    return by_class, distance(bins, ref.shares), total


def verdict(by_class: float | None, by_word: float | None, total: int) -> bool:
    return (by_class is None or by_class <= MAX_CLASSES) and (by_word is None or by_word <= MAX_WORDS + WORD_SLACK / total ** 0.5)


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance) for every row."""
    refs = references(docs, text_col=text_col, lang_col=lang_col)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for lang, text in zip(b.column(1).to_pylist(), binary_column(b, "text")):
                counts = base_counts(text)
                failed = base_failed(counts[0], counts[-1])
                ref = refs.get(lang) or refs.get(None)
                by_class, by_word, total = divergence(text, ref) if ref else (None, None, 0)
                rows.append((*counts, failed, not failed and verdict(by_class, by_word, total), by_class, by_word))
            cols = list(zip(*rows)) or [()] * 9
            yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds[1:]))], names=names)
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                    text_or_empty(text_col).alias("text"))
    return x.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                             "base_failed boolean, kept boolean, class_distance double, word_distance double")
