"""Toxicity from a weighted lexicon matched by Aho-Corasick.

Folding. Text is lower-cased; look-alike letters of other scripts, accented
letters and digits or signs that stand for letters become plain letters, so
``1d10t`` and ``іdіot`` read as ``idiot``.

Lexicon. Entries are folded words and word beginnings of 4 to 8 letters (a
beginning stands for inflected and compound forms), weighted by their log
odds between toxic and clean documents. They are learnt from a bounded
sample of labelled rows (``FIT_ROWS``). An entry is counted once for each
different word before it: a phrase that many copies of one document repeat
counts once.

Matching. One automaton finds all entries and exception phrases in the
folded text. A hit counts where it starts a word (and ends it, for a whole
word), outside exception phrases (harmless uses, such as ``trash can``; more
are learnt: pairs of an entry and its neighbour word found in clean documents). Each
word counts once, by its heaviest entry. The sum, per 100 words and
in all, goes through a logistic curve fitted on rows of the sample that the
lexicon was not learnt from.

Nulls and odd rows: a null text is the empty text and scores like any text
without hits; labels that are null are left out, of repeated labels of a
document the highest counts; without labels of both kinds every score is 0;
repeated rows and null ids are scored like others; an empty table gives no
rows.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_bucket, text_or_empty

#: Labelled rows used to fit, at most; three quarters for the lexicon, one for the curve.
FIT_ROWS = 10_000
ENTRIES = 4000
MIN_DOCS = 6
MIN_CONTEXTS = 5
MIN_LOG_ODDS = 2.5
PREFIXES = range(4, 9)
#: Entries that a task counts before it hands them on.
HELD_ENTRIES = 200_000

# Letters of other scripts that look like Latin ones, and
# digits and signs written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "п": "n", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a"}
# Harmless phrases of common entries.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "sore loser", "pond scum", "killer whale")


def _fold_table() -> dict[int, str]:
    """Accented letters map to their base letter (by Unicode decomposition),
    full-width forms to plain ones, look-alikes and digits as listed."""
    table = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if base != chr(code):
            table[code] = base
    return table | {ord(k): v for k, v in (LOOKALIKES | DIGITS).items()} | dict.fromkeys(range(0x300, 0x370), "")


FOLD = _fold_table()
WORDS = re.compile(r"[^\W\d_]+")
DOLLAR = re.compile(r"\$(?=\w)")  # an s inside or at the start of a word


def fold(text: str) -> str:
    if "$" in text:
        text = DOLLAR.sub("s", text)
    return text.lower().translate(FOLD)


def entries_of(word: str) -> list[str]:
    """Lexicon entries a folded word can match: itself, closed by a blank,
    and its beginnings."""
    return [word + " ", *(word[:n] for n in PREFIXES if n <= len(word))]


class Matcher:
    """Aho-Corasick over weighted entries and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: Sequence[str] = ()):
        self.auto = ahocorasick.Automaton()
        for e, w in weights.items():
            key = e.rstrip(" ")
            old = self.auto.get(key, None)
            whole, begin = (old[1], old[2]) if old else (0.0, 0.0)
            self.auto.add_word(key, (len(key), w if e != key else whole, w if e == key else begin, False))
        for e in exceptions:
            old = self.auto.get(e, None)
            self.auto.add_word(e, (len(e), *(old[1:3] if old else (0.0, 0.0)), True))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of each word hit outside exception phrases."""
        if not len(self.auto):
            return []
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        n = len(folded)
        for last, (size, whole, begin, exception) in self.auto.iter(folded):
            start = last + 1 - size
            if start and folded[start - 1].isalpha():
                continue
            ends = last + 1 == n or not folded[last + 1].isalpha()
            if exception and ends:
                spared.append((start, last + 1))
            w = max(begin, whole if ends else 0.0)
            if w > best.get(start, 0.0):
                best[start] = w
        return [(s, w) for s, w in best.items() if not any(a <= s < b for a, b in spared)]


def features(matcher: Matcher, text: str) -> tuple[float, float]:
    """(per 100 words, in all): logarithms of the hits' summed weights."""
    folded = fold(text)
    total = sum(w for _, w in matcher.hits(folded))
    return math.log1p(100 * total / (len(text.split()) + 10)), math.log1p(total)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (y - p) - ridge * b
        b = b + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), grad)
    return b


class Model:
    """Lexicon, exceptions and curve; small (``ENTRIES`` rows) and picklable."""

    def __init__(self, weights: dict[str, float], exceptions: Sequence[str], curve: Sequence[float] | None):
        self.weights, self.exceptions, self.curve = weights, tuple(exceptions), None if curve is None else list(map(float, curve))

    def scorer(self) -> Callable[[str | None], float]:
        if self.curve is None:
            return lambda text: 0.0
        matcher, (c, by_length, in_all) = Matcher(self.weights, self.exceptions), self.curve

        def score(text: str | None) -> float:
            f, g = features(matcher, text or "")
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, c + by_length * f + in_all * g))))
        return score


def most_specific(counts: dict[str, int]) -> set[str]:
    """Entries without those that a longer one explains: a beginning goes if
    nine tenths of its documents have one longer entry that starts with it."""
    keep, order = set(), sorted(counts)
    for i, e in enumerate(order):
        if not e.endswith(" "):
            longer = next((o for o in itertools.takewhile(lambda o: o.startswith(e), order[i + 1:]) if counts[o] >= 0.9 * counts[e]), None)
            if longer:
                continue
        keep.add(e)
    return keep


def _entry_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic, n): documents per entry, added up within the task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        rows = [(e, y, n) for y, c in enumerate(counts) for e, n in c.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64())],
                               names=["entry", "toxic", "n"])
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[toxic].update({e for w in set(WORDS.findall(fold(text))) for e in entries_of(w)})
        if sum(map(len, counts)) > HELD_ENTRIES:
            yield flush()
            for c in counts:
                c.clear()
    yield flush()


def _context_finder(weights: dict[str, float]) -> Callable:
    """(entry, toxic, before, after): the words around each candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = WORDS.findall(fold(text))
                for i, w in enumerate(words):
                    for e in entries_of(w):
                        if e in weights:
                            rows.add((e, toxic, w, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.record_batch([pa.array(c, pa.int32() if i == 1 else pa.string()) for i, c in enumerate(cols)],
                                  names=["entry", "toxic", "word", "before", "after"])
    return run


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fit_rows: int = FIT_ROWS, exceptions: Sequence[str] = EXCEPTIONS) -> Model:
    """Learn from labelled documents whose crc32(doc_id) mod ``folds`` is not
    0: at most ``fit_rows`` of them, those with the smallest id hashes."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (id_bucket("doc_id", folds) != 0)) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).collect()
    if len({r["toxic"] for r in sample}) < 2:
        return Model({}, exceptions, None)
    sample = docs.sparkSession.createDataFrame([tuple(r) for r in sample], "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .join(F.broadcast(sample), "doc_id")
    # Of a repeated id, the text with the smallest hash.
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("r")).select("r.*")
    texts = texts.select("text", "toxic", F.pmod("h", F.lit(4)).alias("part")).checkpoint()  # at most fit_rows rows; used several times
    learn = texts.filter("part != 0").select("text", "toxic")
    docs_of = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = docs_of.get(1, 0), docs_of.get(0, 0)
    counts = learn.mapInArrow(_entry_counter, "entry string, toxic int, n long").groupBy("entry").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (n1 + 1)) - F.log((F.col("c") + 0.5) / (n0 + 1))
    found = counts.filter(F.col("t") >= MIN_DOCS).withColumn("w", odds).filter(F.col("w") >= MIN_LOG_ODDS)
    top = found.orderBy((F.col("t") * F.col("w")).desc(), "entry").limit(ENTRIES).collect()
    specific = most_specific({r["entry"]: r["t"] for r in top})
    weights = {r["entry"]: r["w"] for r in top if r["entry"] in specific}
    # Contexts: different words before an entry; a copied text has one.
    near = learn.mapInArrow(_context_finder(weights), "entry string, toxic int, word string, before string, after string").distinct()
    per = near.groupBy("entry").agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("before"))).alias("t"),
                                    F.count_distinct(F.when(F.col("toxic") == 0, F.col("before"))).alias("c")).collect()
    weights = {r["entry"]: weights[r["entry"]] for r in per if r["t"] >= MIN_CONTEXTS and r["t"] > 2 * r["c"]}
    pairs = near.filter(F.col("entry").isin([*weights]) if weights else F.lit(False))
    both = [F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "after")]
    seen = [pairs.select(p.alias("phrase"), "toxic", F.col("after" if i == 0 else "before").alias("side")) for i, p in enumerate(both)]
    learnt = seen[0].unionByName(seen[1]).distinct().groupBy("phrase").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter((F.col("c") >= MIN_CONTEXTS) & (F.col("c") > 4 * F.col("t")))
    exceptions = [*exceptions, *(r["phrase"] for r in learnt.orderBy(F.col("c").desc(), "phrase").limit(ENTRIES).collect())]
    model = Model(weights, exceptions, None)
    held = texts.filter("part = 0").select("text", "toxic")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.weights, model.exceptions)
        for b in batches:
            f = [features(matcher, t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([x[0] for x in f], pa.float64()), pa.array([x[1] for x in f], pa.float64()), b.column(1)],
                                  names=["f", "g", "toxic"])
    rows = held.mapInArrow(measure, "f double, g double, toxic int").collect()  # at most fit_rows rows
    if len({r["toxic"] for r in rows}) < 2:
        return Model({}, exceptions, None)
    return Model(weights, exceptions, fit_curve(np.array([(r["f"], r["g"]) for r in rows]), np.array([r["toxic"] for r in rows], float)))


def score_column(model: Model, text_col: str = "text"):
    """A column with the score of each row's whole text."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for t in texts:
            yield t.map(one).astype(float)
    score = score.asNondeterministic()  # evaluated once, not once per use
    return score(text_or_empty(text_col))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = fit(docs, labels, folds)
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    x = x.select("doc_id", (id_bucket("doc_id", folds) == 0).alias("held_out"), score_column(model).alias("score"))
    return x.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
