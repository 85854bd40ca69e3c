"""Secret scan: base patterns, and values that are hard to guess.

Base patterns (leftmost, non-overlapping per kind; a match that fails its
length is dropped but still consumes its text):

* ``assign``: a credential name, ``:`` or ``=``, a value of 12 or more;
* ``access``: ``AKIA`` and capitals or digits, 18 characters or more;
* ``hex``: 16 or more of 0-9 and a-f.

Guess cost. Values in a credential context (a wider set of names, separators
and value characters than ``assign``; up to the matching quote on the line, or
without quotes up to white space, less the punctuation and brackets around it) are cut into words, dates, repeats,
keyboard walks and brute-force spans so that the guesses needed for all of
them, multiplied, are fewest: a dynamic programme over the value's positions
in log10. A value that needs 10**``MIN_GUESSES`` guesses or more is a span of
kind ``guess``; ``password: hunter2`` or ``token: see below`` is not. Words
are a few common ones and the corpus's own: the ``LEARNT`` most frequent
words of plain letters, counted over all texts. Addresses, and unquoted
expressions that fetch a value, are no values.

Spans are (kind, start, end) in code points, end exclusive, ordered by start
and then by kind as listed here. One row per input row; a null text is the
empty text, null ids and repeated rows are kept, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .collocations import word_counts
from .common import text_or_empty

KINDS = ("assign", "access", "hex", "guess")
MIN_GUESSES = 10.0
#: Words learnt from the corpus, at most, and the least they occur.
LEARNT, LEARNT_COUNT = 20_000, 5
MASK = "[secret]"

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs are maximal, so the length can be asked for at once
HEX = re.compile(r"[0-9a-f]{16,}")
CONTEXT = re.compile(
    r"(?:(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credential|bearer|(?:api|access|private|auth|encryption|signing)[_ -]?key)s?"
    r"[\"']?[ \t]*(?::=|=>|[:=]|\bis\b)|\bbearer(?=[ \t]))[ \t]*"
    r"(?:\"((?:[^\"\\\r\n]|\\.)*)\"|'((?:[^'\\\r\n]|\\.)*)'|[\"']?(\S{6,}))", re.ASCII | re.IGNORECASE)
#: Signs around an unquoted value that are not of it.
BEFORE, AFTER = "([{<\"'", ".,;:!?\"'<>)]}"
ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://")
EXPRESSION = re.compile(r"\$[({A-Za-z_]|\{\{|%[({]|[A-Za-z_][A-Za-z_.]*(?:\[|\()")

# Common passwords and words, most common first.
COMMON = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login princess football shadow sunshine iloveyou "
    "trustno1 hunter abc123 baseball superman batman access secret token test guest root user default changeme example "
    "sample dummy placeholder none null true false your here value key api pass word the and for you not with this that "
    "from have see below above enter insert replace xxxx todo my new old home work love summer winter spring autumn "
    "january february march april may june july august september october november december monday friday sunday "
    "company server client public private database system service account email name number hello world computer internet"
).split()
# Rows of a keyboard, and the orders people type.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp", "1qaz2wsx3edc4rfv5tgb6yhn")
# Signs written for letters in words.
LEET = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d")

_RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys(COMMON))}
_LONGEST = max(map(len, _RANK))
_STEPS = {(a, b): d for d in (1, -1) for w in WALKS for a, b in zip(w[::d], w[::d][1:])}


def _word(span: str, words: Mapping[str, int] = {}) -> float | None:
    """Guesses (log10) of a dictionary word, its capitals and signs."""
    low = span.lower()
    plain = low if low in _RANK or low in words else low.translate(LEET)
    rank = _RANK.get(plain) or words.get(plain)
    if rank is None:
        return None
    cost = math.log10(rank)
    caps = sum(c.isupper() for c in span)
    if caps and not (caps == len(span) or caps == 1 and span[0].isupper()):
        cost += math.log10(math.comb(len(span), caps))
    return cost + 0.3 * (caps > 0) + 0.3 * sum(a != b for a, b in zip(low, plain))


RUNS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[^\W\d_A-Za-z]+|[\W_]+")


def _per_character(value: str) -> list[float]:
    """Guesses (log10) of each character on its own, by the run of its kind
    that it stands in: letters that read like a word are easier than random
    ones, whatever else the value holds."""
    letters = 52 if value.lower() != value != value.upper() else 26
    out: list[float] = []
    for m in RUNS.finditer(value):
        run = m[0]
        spoken = len(run) >= 4 and run.isalpha() and not re.search("[bcdfghjklmnpqrstvwxz]{5}", run.lower())
        each = 0.7 if spoken else math.log10(letters) if run.isalpha() else 1.0 if run.isdigit() else math.log10(33)
        out += [each] * len(run)
    return out


def _walk_ends(value: str) -> list[int]:
    """For each position, the end of the keyboard walk (one direction) there."""
    low = value.lower()
    ends = list(range(1, len(low) + 1))
    for i in range(len(low) - 2, -1, -1):
        step = _STEPS.get((low[i], low[i + 1]))
        onward = step is not None and (ends[i + 1] == i + 2 or _STEPS.get((low[i + 1], low[i + 2])) == step)
        ends[i] = ends[i + 1] if onward else i + 2 if step is not None else i + 1
    return ends


def guess_cost(value: str, words: Mapping[str, int] = {}) -> tuple[float, list[tuple[str, int, int]]]:
    """(log10 of the fewest guesses, the segments that need them); ``words``
    are more words and their ranks."""
    n = len(value)
    if not n:
        return 0.0, []
    longest = max(_LONGEST, WORD_LENGTHS[1] if words else 0)
    each = _per_character(value)
    best = [0.0] + [math.inf] * n
    back: list[tuple[str, int]] = [("", 0)] * (n + 1)
    brute = [math.inf] * (n + 1)  # cheapest with the last character inside a brute-force span
    begun = [0] * (n + 1)
    walks = _walk_ends(value)
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            dates.setdefault(m.end(), []).append(i)
    repeats: dict[int, list[tuple[int, float]]] = {}
    for m in re.finditer(r"(.{1,8}?)\1{2,}", value, re.DOTALL):
        unit = m[1]
        cost = (_word(unit, words) if len(unit) > 2 and _word(unit, words) is not None else sum(each[m.start():m.start() + len(unit)])) \
            + math.log10(len(m[0]) // len(unit))
        repeats.setdefault(m.end(), []).append((m.start(), cost))
    walk_to: dict[int, list[int]] = {}
    for i, e in enumerate(walks):
        if e - i >= 4:
            walk_to.setdefault(e, []).append(i)

    def offer(i: int, j: int, cost: float, kind: str) -> None:
        total = best[i] + cost + (0.3 if i else 0.0)  # where a segment starts must be guessed too
        if total < best[j]:
            best[j], back[j] = total, (kind, i)

    for j in range(1, n + 1):
        start = best[j - 1] + (0.3 if j > 1 else 0.0)
        begun[j] = begun[j - 1] if brute[j - 1] <= start else j - 1
        brute[j] = min(brute[j - 1], start) + each[j - 1]
        if brute[j] < best[j]:
            best[j], back[j] = brute[j], ("brute", begun[j])
        for i in range(max(0, j - longest), j - 2):
            if (c := _word(value[i:j], words)) is not None:
                offer(i, j, c, "word")
        for i in dates.get(j, ()):
            offer(i, j, math.log10(366 * 100) if j - i > 4 else 2.0, "date")
        for i, c in repeats.get(j, ()):
            offer(i, j, c, "repeat")
        for i in walk_to.get(j, ()):
            offer(i, j, math.log10(2 * sum(map(len, WALKS))) + math.log10(j - i), "walk")
    segments, j = [], n
    while j:
        kind, i = back[j]
        segments.append((kind, i, j))
        j = i
    return best[n], segments[::-1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    low = text.lower()
    out = []
    if any(k in low for k in ("passw", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def guess_spans(text: str, least: float = MIN_GUESSES, words: Mapping[str, int] = {}) -> list[tuple[int, int, int]]:
    """Values in a credential context that need 10**least guesses."""
    low = text.lower()
    if not any(k in low for k in ("pass", "pwd", "secret", "token", "credential", "bearer", "key")):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        start, value = m.start(m.lastindex), m[m.lastindex]
        if m.lastindex == 3:
            bare = value.lstrip(BEFORE)
            start, value = start + len(value) - len(bare), bare.rstrip(AFTER)
            if EXPRESSION.match(bare):
                continue
        if len(value) >= 6 and not ADDRESS.match(value) and guess_cost(value, words)[0] >= least:
            out.append((start, 3, start + len(value)))
    return out


#: Lengths of learnt words.
WORD_LENGTHS = 3, 20


def learn_words(docs: DataFrame, limit: int = LEARNT, text_col: str = "text") -> dict[str, int]:
    """Ranks of the corpus's most frequent words of plain letters, after the
    common ones; ``limit`` words at most come to the driver."""
    x = docs.select(F.lit("").alias("lang"), text_or_empty(text_col).alias("text"))
    n = word_counts(x).filter(F.col("word").rlike("^[a-z]{%d,%d}$" % WORD_LENGTHS) & (F.col("n") >= LEARNT_COUNT))
    top = n.orderBy(F.col("n").desc(), "word").limit(limit).collect()
    return {r["word"]: len(_RANK) + i for i, r in enumerate(top, 1)}


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = MIN_GUESSES, words: Mapping[str, int] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans);
    without ``words`` they are learnt from ``docs``."""
    words = learn_words(docs, text_col=text_col) if words is None else words
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base, more = base_spans(text), guess_spans(text, least, words)
                kinds = [k for _, k, _ in base + more]
                rows.append((doc, *(kinds.count(k) for k in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return x.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(text: str, least: float = MIN_GUESSES, mask: str = MASK, words: Mapping[str, int] = {}) -> str:
    """The text with every span, overlapping ones together, replaced. Of an
    ``assign`` match only the value goes, so the name stays readable."""
    cuts = []
    for s, k, e in base_spans(text) + guess_spans(text, least, words):
        cuts.append((ASSIGN.match(text, s).start(2) if k == 0 else s, e))
    out, at = [], 0
    for s, e in sorted(cuts):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def redacted_column(text_col: str = "text", least: float = MIN_GUESSES, mask: str = MASK, words: Mapping[str, int] = {}):
    """A column with each row's text redacted; a null text stays null."""
    def make() -> Callable:
        @F.pandas_udf("string")
        def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for t in texts:
                yield t.map(lambda x: None if x is None else redact(x, least, mask, words))
        return clean.asNondeterministic()  # evaluated once, not once per use
    return make()(F.col(text_col))
