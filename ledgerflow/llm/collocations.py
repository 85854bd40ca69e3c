"""Phrase collocations: counted by broadcast tries, scored by their weakest cut.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
these into words at blanks and tabs. Everything is counted per language.

Level by level. A scan counts the words. A phrase of m+1 words is a candidate
only if its first m and its last m words are phrases with ``min_count``
occurrences: a scan walks the phrases of m words through the texts, and where
they begin at two positions in a row, the longer phrase is counted. The counts
of tasks added up are exact, as a phrase that reaches ``min_count`` has only
parts that do, so none of its occurrences is passed over. There is one scan a
level, however many phrases the level has.

Counting. Phrases are dealt by a hash of their first word into shards of about
``SHARD`` phrases; ``AT_ONCE`` tries are a group, broadcast and held by a task
together. A trie is a double array over the base-``DIGIT`` digits of the
shard's own word numbers. A task turns ``HELD`` blocks of text into word numbers,
walks one group after another through them, and moves the states of all
positions that begin with a first word of the trie together, one word after
another: a position takes part in one trie, however many there are.

Score of a candidate, of a occurrences: a cut after its first k words whose
parts occur l and r times gives floor(1000000*a*a / (l*r)), in exact decimal
arithmetic; the lowest cut counts, ties to the smallest k. A candidate inside
a longer one that has at least half its occurrences is dropped.

Nulls and odd rows: a null text is the empty text and has no words; a null
language is ``und``; repeated rows count each time; ids are not read; an
empty table, or one without a candidate, gives no rows. Ties in the ranking go to the more
frequent phrase, then to the first in UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, split_words, stored, text_or_empty

#: Phrases in a trie, about; tries held together.
SHARD = 200_000
AT_ONCE = 5
#: Blocks of text that a task walks one group of tries through.
HELD = 4
#: Word positions that a task handles together; rows in a batch that it hands on.
BLOCK = 1_000_000
OUT_ROWS = 50_000
DIGIT = 512
#: Languages whose totals are broadcast.
MANY_LANGS = 10_000

NO_LANG = "und"
BREAK = b"\xff"  # not a byte of UTF-8
_FOLD = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")


_FOLD_BYTES = np.frombuffer(bytes(range(256)).lower().translate(_FOLD), np.uint8)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, with ``BREAK`` between pieces."""
    return text.lower().translate(_FOLD).replace(BREAK, b" \xff ").split()


def all_tokens(texts: pa.Array) -> pa.Array:
    """``tokens`` of several texts, each after a ``BREAK``, in Arrow kernels."""
    return split_words(texts, _FOLD_BYTES, BREAK, True)


class Block(NamedTuple):
    """Texts of one language: ``codes`` number the distinct ``words``; 0 is a
    break, and there is one at both ends."""
    lang: str
    codes: np.ndarray
    words: pa.BinaryArray


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[Block]:
    """Blocks of about ``size`` positions from batches of (lang, text)."""
    held: dict[str, list[pa.Array]] = {}
    n = 0

    def flush() -> Iterator[Block]:
        for lang, parts in held.items():
            all_words = pa.concat_arrays([*parts, pa.array([BREAK], pa.binary())]).dictionary_encode()
            yield Block(lang, all_words.indices.to_numpy(zero_copy_only=False), all_words.dictionary)
        held.clear()
    for b in batches:
        langs, texts = b.column(0), b.column(b.schema.get_field_index("text"))
        for lang in langs.unique().to_pylist():
            words = all_tokens(texts.filter(pc.equal(langs, lang)))
            held.setdefault(lang, []).append(words)
            n += len(words)
        if n >= size:
            yield from flush()
            n = 0
    yield from flush()


def texts_by_lang(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), text_or_empty(text_col).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n); the row whose word is null has the language's total."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, codes, words in blocks(batches):
            n = np.bincount(codes, minlength=len(words))
            w = pa.concat_arrays([words[1:].cast(pa.string()), pa.array([None], pa.string())])
            yield pa.record_batch([pa.array([lang] * len(n), pa.string()), w, pa.array(np.append(n[1:], n[1:].sum()), pa.int64())],
                                  names=["lang", "word", "n"])
    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Trie(NamedTuple):
    """Double array: from state s, digit d leads to t = base[s] + d if
    check[t] is s. ``words``, joined by ``BREAK``, have the numbers 1.. in
    order; phrase i ends in state ``ends[i]`` (ascending) and is known outside as ``nums[i]``."""
    base: np.ndarray
    check: np.ndarray
    words: bytes
    ends: np.ndarray
    nums: np.ndarray

    def word_list(self) -> list[bytes]:
        return self.words.split(BREAK)

    def digits(self, words: int) -> list[np.ndarray]:
        """For each digit place, the digit (1..) of every word number."""
        numbers = np.arange(words + 1)
        return [(numbers // DIGIT ** p % DIGIT + 1).astype(np.int32) for p in range(places(words))][::-1]

    def step(self, states: np.ndarray, numbers: np.ndarray, digits: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(which of the states live on, theirs after the word)."""
        live = np.flatnonzero(numbers)
        s, numbers = states[live], numbers[live]
        for d in digits:
            t = self.base[s] + d[numbers]
            ok = self.check[t] == s
            live, s, numbers = live[ok], t[ok], numbers[ok]
        return live, s


def places(words: int) -> int:
    """Digits needed for the numbers up to ``words``."""
    return 1 if words < DIGIT else 2 if words < DIGIT ** 2 else 3


ROOT = 0
FIRST = DIGIT + 2  # children lie from here on, so that no base is negative


def double_array(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, end state of each row) for distinct rows of digits in
    lexicographic order. Nodes with several children take the first of a few
    places that are free for all of them, or new room; nodes with one child
    then fill the holes, all together."""
    n, depth = rows.shape
    free = np.ones(FIRST + 2 * n + 4 * DIGIT, dtype=bool)
    free[:FIRST] = False
    base, check = np.zeros(len(free), np.int32), np.full(len(free), -1, np.int32)
    top = FIRST
    state = np.full(n, ROOT, np.int64)
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for d in range(depth):
        parents = new
        new = parents.copy()
        new[1:] |= rows[1:, d] != rows[:-1, d]
        kids = np.flatnonzero(new)
        digit, of = rows[kids, d], state[kids]
        begins = np.flatnonzero(parents[kids])
        sizes = np.diff(np.append(begins, len(kids)))
        while len(free) < top + 2 * len(kids) + 4 * DIGIT:
            free = np.append(free, np.ones(len(free), dtype=bool))
            base, check = np.append(base, np.zeros_like(base)), np.append(check, np.full_like(check, -1))
        slots = np.empty(len(kids), np.int64)
        low = FIRST
        for k in np.argsort(-sizes, kind="stable")[:int((sizes > 1).sum())].tolist():
            own = slice(begins[k], begins[k] + sizes[k])
            away = digit[own] - digit[begins[k]]
            open_ = low + np.flatnonzero(free[low:low + 256])[:16]
            fits = free[open_[:, None] + away].all(axis=1)
            at = int(open_[fits.argmax()]) if fits.any() else top
            if not fits.any():
                low = min(low + 128, top)
            slots[own] = at + away
            free[slots[own]] = False
            top = max(top, at + int(away[-1]) + 1)
            while len(free) < top + 2 * DIGIT + 512:
                free = np.append(free, np.ones(len(free), dtype=bool))
                base, check = np.append(base, np.zeros_like(base)), np.append(check, np.full_like(check, -1))
        single = begins[sizes == 1]
        holes = FIRST + np.flatnonzero(free[FIRST:top + len(single)])[:len(single)]
        slots[single] = holes
        free[holes] = False
        if len(holes):
            top = max(top, int(holes[-1]) + 1)
        base[of] = slots - digit
        check[slots] = of
        state = np.repeat(slots, np.diff(np.append(kids, n)))
    return base[:top + DIGIT + 1], check[:top + DIGIT + 1], state


def make_trie(langs: Sequence[str], phrases: Sequence[str], nums: np.ndarray) -> Trie:
    """A trie of phrases of one word count, each below its language."""
    split = [(b"\xfe" + lang.encode(), *p.encode().split(b" ")) for lang, p in zip(langs, phrases)]
    words = sorted({w for row in split for w in row})
    number = {w: i for i, w in enumerate(words, 1)}
    grid = np.array([[number[w] for w in row] for row in split], np.int64)
    p = places(len(words))
    rows = np.concatenate([grid[:, [c]] // DIGIT ** np.arange(p - 1, -1, -1) % DIGIT + 1 for c in range(grid.shape[1])], axis=1)
    order = np.lexsort(rows.T[::-1])
    base, check, ends = double_array(rows[order])
    by_end = np.argsort(ends)
    return Trie(base, check, BREAK.join(words), ends[by_end].astype(np.int32), np.asarray(nums, np.int64)[order][by_end])


def tries(level: DataFrame, count: int, shard: int, name: str) -> DataFrame:
    """One row per shard of ``level`` (lang, phrase, num), as stored bytes."""
    shards = max(1, -(-count // shard))

    def build(t: pa.Table) -> pa.Table:
        trie = make_trie(t.column("lang").to_pylist(), t.column("phrase").to_pylist(), t.column("num").to_numpy())
        cols = [pa.array([int(t.column("shard")[0].as_py())], pa.int32()), *(pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in (
            (trie.base, np.int32), (trie.check, np.int32), (trie.ends, np.int32), (trie.nums, np.int64))),
            pa.array([trie.words], pa.binary())]
        return pa.table(cols, names=["shard", "base", "check", "ends", "nums", "words"])
    first = F.substring_index("phrase", " ", 1)
    x = level.select("lang", "phrase", "num", F.pmod(F.xxhash64("lang", first), F.lit(shards)).cast("int").alias("shard"))
    return stored(x.groupBy("shard").applyInArrow(build, "shard int, base binary, check binary, ends binary, nums binary, words binary"), name)


def read_trie(r) -> Trie:
    return Trie(np.frombuffer(r["base"], np.int32), np.frombuffer(r["check"], np.int32), bytes(r["words"]),
                np.frombuffer(r["ends"], np.int32), np.frombuffer(r["nums"], np.int64))


class _Walker:
    """A group of tries, in a task: one dictionary for the words of all."""

    def __init__(self, tries: Sequence[Trie]):
        self.tries, self.number, self.local, self.digits, self.nums = tries, {}, [], [], []
        lists = [t.word_list() for t in tries]
        for words in lists:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)
        for t, words in zip(tries, lists):
            local = np.zeros(len(self.number) + 1, np.int32)  # a word's number in this trie
            local[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
            self.local.append(local)
            self.digits.append(t.digits(len(words)))
            nums = np.full(len(t.base), -1, np.int64)  # of the accepting states
            nums[t.ends] = t.nums
            self.nums.append(nums)

    def walk(self, block: Block, m: int, out: np.ndarray) -> None:
        """Writes to ``out`` the number of the phrase of m words that begins
        at each position, if these tries have it."""
        known = np.fromiter(map(self.number.get, block.words.to_pylist(), repeat(0)), np.int32, len(block.words))
        lang = self.number.get(b"\xfe" + block.lang.encode(), 0)
        for t, local, digits, nums in zip(self.tries, self.local, self.digits, self.nums):
            _, start = t.step(np.array([ROOT]), local[[lang]], digits)
            if not len(start):
                continue
            mine = local[known]
            after = np.full(len(mine), -1, np.int32)  # the state after each word of the block, as a first one
            live, s = t.step(np.full(len(mine), start[0], np.int32), mine, digits)
            after[live] = s
            at = np.flatnonzero((after >= 0)[block.codes])
            s = after[block.codes[at]]
            for j in range(1, m):
                # No position runs over the end: the last code is a break.
                live, s = t.step(s, mine[block.codes[at + j]], digits)
                at = at[live]
            out[at] = nums[s]


def held_blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[list[Block]]:
    held: list[Block] = []
    for block in blocks(batches):
        held.append(block)
        if sum(len(b.codes) for b in held) >= n * BLOCK:
            yield held
            held = []
    if held:
        yield held


def scan(texts: DataFrame, groups: Iterable[DataFrame], m: int, count: int, min_count: int) -> DataFrame:
    """Walk the ``count`` phrases of m words, numbered from 0 in groups of
    stored tries, through all texts: (num, next, f) of every phrase of m+1
    words with ``min_count`` occurrences, its first m words being phrase num
    and its last m phrase next."""
    # The driver lets go of a group once it is written for the tasks.
    sent = [texts.sparkSession.sparkContext.broadcast([read_trie(r) for r in g.toLocalIterator()]) for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _Walker(sent[0].value) if len(sent) == 1 else None
        for held in held_blocks(batches, 1 if only else HELD):
            nums = [np.full(len(b.codes) + 1, -1, np.int64) for b in held]
            for group in sent:
                own = only or _Walker(group.value)
                for block, out in zip(held, nums):
                    own.walk(block, m, out)
                own = None
                if not only:
                    vars(group).pop("_value", None)  # else the worker keeps every group it has read
            pairs = []
            while nums:
                num = nums.pop()
                at = np.flatnonzero((num[:-1] >= 0) & (num[1:] >= 0))
                pairs.append(num[at] * count + num[at + 1])
            found, n = np.unique(np.concatenate(pairs), return_counts=True)
            for i in range(0, len(n), OUT_ROWS):
                yield pa.record_batch([pa.array(found[i:i + OUT_ROWS]), pa.array(n[i:i + OUT_ROWS], pa.int64())], names=["pair", "n"])
    found = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    out = stored(found.select(F.expr(f"pair div {count}L").alias("num"), F.expr(f"pair % {count}L").alias("next"), "f"), "phrases-seen")
    for group in sent:
        group.destroy()
    return out


def numbered(level: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(level with ``num``, its rows): numbers from 0 on, without gaps."""
    x = stored(level.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    before, count = [], 0
    for r in sorted(x.groupBy(part.alias("part")).count().collect()):  # a row per partition
        before.append((r["part"], count))
        count += r["count"]
    offsets = F.broadcast(level.sparkSession.createDataFrame(before, "_part long, _before long"))
    num = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return x.withColumn("_part", part).join(offsets, "_part").withColumn("num", num).drop("_at", "_part", "_before"), count


def _longer(level: DataFrame, seen: DataFrame) -> DataFrame:
    """(lang, phrase, f) of what a scan of ``level`` has found."""
    last = level.select(F.col("num").alias("next"), F.element_at(F.split("phrase", " ", -1), -1).alias("last"))
    c = seen.join(level.select("num", "lang", "phrase"), "num").join(last, "next")
    return c.select("lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "f")


def frequent_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, shard: int = SHARD, at_once: int = AT_ONCE,
                     text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, m, f) of all phrases of up to ``max_words`` words with
    ``min_count`` occurrences, (lang, n) with each language's words)."""
    texts = texts_by_lang(docs, text_col, lang_col)
    words = stored(word_counts(texts).filter(F.col("word").isNull() | (F.col("n") >= min_count)), "words")
    totals = words.filter("word is null").select("lang", "n")
    level = words.filter("word is not null").select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))
    found = [level.withColumn("m", F.lit(1))]
    for m in range(1, max_words):
        level, count = numbered(level, f"level{m}")
        if not count:
            break
        found[-1] = level.select("lang", "phrase", "f", F.lit(m).alias("m"))
        packed = tries(level, count, shard, f"tries{m}")
        shards = sorted(r["shard"] for r in packed.select("shard").collect())  # one number per shard
        groups = [packed.filter(F.col("shard").isin(shards[i:i + at_once])) for i in range(0, len(shards), at_once)]
        level = _longer(level, scan(texts, groups, m, count, min_count))
        found.append(level.withColumn("m", F.lit(m + 1)))
    return stored(reduce(DataFrame.unionByName, found), "phrases"), totals


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, limit: int = 2000, share: int = 50, shard: int = SHARD,
                 at_once: int = AT_ONCE, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first ``limit`` of each
    language; a phrase goes if a longer one has ``share`` percent of its
    occurrences."""
    phrases, totals = frequent_phrases(docs, max_words, min_count, shard, at_once, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    cand = phrases.filter("m > 1").select("lang", "phrase", F.col("f").alias("a"), "m", words.alias("w"))
    # Inside a longer one: its parts, each with the largest count around it.
    spans = F.expr("flatten(transform(sequence(2, m - 1), k -> transform(sequence(1, m - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    parts = cand.filter("m > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("f"))
    around = parts.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    cand = cand.join(around, ["lang", "phrase"], "left").filter(F.expr(f"around is null or around * 100 < a * {share}"))
    cut = cand.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, m - 1)")).alias("k"), "w").select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left_part"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("right_part"))
    count = phrases.select("lang", "phrase", "f")
    cut = cut.join(count.toDF("lang", "left_part", "l"), ["lang", "left_part"]).join(count.toDF("lang", "right_part", "r"), ["lang", "right_part"])
    big = {c: f"cast({c} as decimal(16,0))" for c in "alr"}
    score = F.expr(f"({big['a']} * {big['a']} * cast(1000000 as decimal(7,0))) div ({big['l']} * {big['r']})").cast("long")
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("b"))
    x = best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    # A global order, dealt by range, numbers the phrases of every language without one task for it.
    x, _ = ranked(x, [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")], "ranked-phrases")
    first = stored(x.groupBy("lang").agg(F.min("_rank").alias("_first")).join(totals, "lang"), "languages")
    if first.count() <= MANY_LANGS:  # else a join by language
        first = F.broadcast(first)
    x = x.join(first, "lang").withColumn("rank", F.col("_rank") - F.col("_first") + 1).filter(F.col("rank") <= limit)
    return x.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))


def oracle_sql() -> str:
    """DuckDB SQL for ``op13``: words by position, n-grams by offset, wide
    integers for the score."""
    fold = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with pieces as (select lang, row_number() over () as p, piece from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({fold}, '[.,;:!?\x0A-\x0D]')) as piece from documents)),
words as (select lang, p, unnest(w) as w, unnest(range(len(w))) as i from (
    select lang, p, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces)),
grams as (select lang, w as w1, lead(w, 1) over o as w2, lead(w, 2) over o as w3 from words window o as (partition by p order by i)),
totals as (select lang, count(*) as n from words group by lang),
f as (select lang, w1 as phrase, 1 as m, count(*) as f, w1, null as w2, null as w3 from grams group by all
    union all select lang, w1 || ' ' || w2, 2, count(*), w1, w2, null from grams where w2 is not null group by all
    union all select lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*), w1, w2, w3 from grams where w3 is not null group by all),
many as (select * from f where f >= 10),
around as (select lang, phrase, max(f) as around from (
    select lang, w1 || ' ' || w2 as phrase, f from many where m = 3 union all select lang, w2 || ' ' || w3, f from many where m = 3) group by all),
cand as (select c.* from many c left join around x using (lang, phrase) where c.m > 1 and (x.around is null or 100 * x.around < 50 * c.f)),
cuts as (select lang, phrase, f as a, 1 as k, w1 as lp, case when m = 2 then w2 else w2 || ' ' || w3 end as rp from cand
    union all select lang, phrase, f, 2, w1 || ' ' || w2, w3 from cand where m = 3),
scored as (select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
    from cuts c join many x on x.lang = c.lang and x.phrase = c.lp join many y on y.lang = c.lang and y.phrase = c.rp),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) as o from scored) where o = 1),
top as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from top join totals using (lang) where rank <= 2000"""
