"""Mixing sources to target weights by pivotal dependent rounding.

Sources get targets in words: weights 5, 2, 1, repeating over the sources in
code point order (null last), share the words of all documents; a target
stops at ``MOST`` times its source's words and the excess is shared again by
weight until none is above. A document of a source is then wanted target /
source size times: a whole number of copies and a fractional probability.

Rounding. Two fractional documents i and j of one source are paired, and
words move from one to the other, in a direction drawn with the odds that
leave both expectations unchanged, until one probability is 0 or 1; the other
goes on to the next pair. The source's expected words never change; ``SPARE``
fractional documents are left. Documents are dealt to chunks by a hash of their
rank, every chunk rounds its own, and what each leaves is combined up a tree
that joins ``FAN`` chunks at a time. Pairs are of one size class (a power of
two), so that short documents don't have to settle a long one. The last
documents left in the classes of a source, a few per power of two, are
settled together, longest first, each taking over what the ones before left,
and the shortest by the choice whose words come nearest to what remains.

Ranks come from one global order by id, tie columns, size and source, so rows without
an id, or with the id of others, spread over all chunks like any other, and a source with a
third of all rows does. Draws hash ranks and a seed, and chunks follow from
ranks and the row count, so reruns over the same rows agree however Spark partitions
them; rows that tie are alike in all that is read of them.

Nulls and odd rows: a null text has no words; documents without words are
rounded by their own draw; a null source is a source of its own, last in
order; null ids and repeated rows are mixed once per row; an empty table
gives no rows; without any words nothing is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, ranked, run_starts, sorted_runs, stored, text_or_empty, unused

# The weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Copies of a document at most.
MOST = 3
CHUNK_ROWS = 8192
FAN = 64
SEED = 20
#: Documents of one source and size class that a run leaves fractional: the
#: last step needs some of every length to come near the target.
SPARE = 4
#: Last documents of a source that are settled by trying every choice.
TRIED = 14


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): the level
    ``a`` at which sum(min(most * size, a * weight)) is all words is found by
    capping what is above and sharing again; each turn is one aggregate."""
    x, _ = ranked(sources, [F.col("source").isNull(), F.col("source")], "sources")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")).cast("double")
    x = stored(x.select("source", "source_size", w.alias("weight")), "weighted-sources")
    cap = F.col("source_size").cast("double") * most
    got = x.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, level, capped = float(got["words"] or 0), 0.0, -1
    free, held, n = got["weight"] or 0.0, 0.0, 0
    while n != capped and free:
        capped, level = n, (words - held) / free
        above = F.col("weight") * level > cap
        r = x.agg(F.sum(F.when(above, cap).otherwise(0.0)).alias("held"), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("free"),
                  F.count_if(above).alias("n")).first()
        held, free, n = r["held"], r["free"], r["n"]
    return x.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def pivot(p: float, a: float, q: float, b: float, draw: float) -> tuple[float, float]:
    """New probabilities of two documents of a and b words: p*a + q*b stays,
    expectations stay, and one of them becomes 0 or 1."""
    up = min(a * (1 - p), b * q)      # words that can move to the first
    down = min(a * p, b * (1 - q))    # or to the second
    if draw * (up + down) < down:
        return (1.0, q - up / b) if up == a * (1 - p) else (p + up / a, 0.0)
    return (0.0, q + down / b) if down == a * p else (p - down / a, 1.0)


def _draw(h: int, step: int) -> float:
    """A number in [0, 1) from a document's hash and its pair's."""
    x = (h * 0x9E3779B97F4A7C15 + step * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 31
    x = x * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 29) / 2.0 ** 64


def _settled(p: float) -> bool:
    return p <= 1e-12 or p >= 1 - 1e-12


def _round_run(p: np.ndarray, a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Pair along a run of one source and size class; at most ``SPARE``
    entries of the result lie between 0 and 1."""
    p = p.copy()
    open_: list[int] = []  # the entries still fractional
    for k in range(len(p)):
        if _settled(p[k]):
            p[k] = round(p[k])
        elif a[k] == 0:
            p[k] = float(_draw(int(h[k]), SEED) < p[k])
        else:
            open_.append(k)
        while len(open_) > SPARE:
            i, j = open_[:2]
            p[i], p[j] = pivot(p[i], a[i], p[j], a[j], _draw(int(h[i]), int(h[j]) + SEED))
            for x in (i, j):
                if _settled(p[x]):
                    p[x] = round(p[x])
                    open_.remove(x)
    return p


def _settle(p: np.ndarray, a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """0 or 1 for the last fractional documents of a source, words nearest to
    the sum of p * a. Beyond ``TRIED``, the longest are rounded one by one,
    each with what the ones before left over."""
    order = np.argsort(-a, kind="stable")
    out, over = np.zeros(len(p)), 0.0
    for i in order[:max(0, len(p) - TRIED)]:
        out[i] = float(p[i] * a[i] + over >= a[i] / 2)
        over += (p[i] - out[i]) * a[i]
    rest = order[max(0, len(p) - TRIED):]
    if len(rest):
        want = float((p[rest] * a[rest]).sum()) + over
        pick = np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1
        out[rest] = pick[np.argmin(np.abs(pick @ a[rest] - want))]
    return out


def _rounder(fn: Callable, keys: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_runs(batches, keys, rows=2000):
            p, a, h = (t.column(c).to_numpy() for c in ("_p", "_a", "_h"))
            at = run_starts(*(t.column(k).to_numpy() for k in keys))
            new = np.concatenate([fn(p[i:j], a[i:j], h[i:j]) for i, j in zip(at[:-1], at[1:])])
            t = t.set_column(t.schema.get_field_index("_p"), "_p", pa.array(new))
            yield from t.to_batches()
    return run


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", copies_col: str = "_copies") -> DataFrame:
    """All columns of ``docs``, whatever their names, and ``copies_col``, by the
    words of the text column. Rows are numbered by writing them; the rounding
    moves numbers only, and texts meet their copies in one join."""
    row, copies = unused(docs, "_row", copies_col)
    x = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    sized = x.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("words"),
                     F.xxhash64(text_or_empty(text_col)).alias("text"))
    taken = mix_sized(sized, "words", weights, most, "id", "source", ["text"]).select(F.col("row").alias(row), F.col("_copies").alias(copies))
    return x.join(taken, row).select(*docs.columns, copies)


def mix_sized(docs: DataFrame, size_col: str, weights: Sequence[int] = WEIGHTS, most: int = MOST, id_col: str = "doc_id",
              source_col: str = "source", tie: Sequence[str] = ()) -> DataFrame:
    """All columns of ``docs`` with _size, _source_size, _target and _copies:
    the copies of each row that the mix takes, from 0 to ``most``. ``tie``
    names columns that tell rows of one id apart. The input must not have
    columns of these names or other internal ones (leading _)."""
    columns = docs.columns
    x = docs.select(*columns, F.col(size_col).alias("_size"), F.col(source_col).cast("string").alias("_source"))
    x, _ = ranked(x, [F.col(id_col).isNull(), F.col(id_col), *map(F.col, tie), F.col("_size"), F.col("_source")], "mix-ranks")
    per_source = stored(x.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n")), "source-sizes")
    rows = per_source.agg(F.sum("n")).first()[0] or 0
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    targets = targets.select(F.col("source").alias("_key"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    x = x.join(targets, x["_source"].eqNullSafe(targets["_key"])).drop("_key")
    wanted = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    chunks = -(-rows // CHUNK_ROWS) or 1
    h = F.xxhash64("_rank", F.lit(SEED))
    x = x.withColumn("_wanted", F.least(wanted, F.lit(float(most)))).withColumns({
        "_h": h, "_a": F.col("_size").cast("double"), "_whole": F.floor("_wanted").cast("double"),
        "_chunk": F.pmod(h, F.lit(chunks)).cast("long"),
        "_group": F.xxhash64(F.col("_source").isNull(), F.col("_source"), F.floor(F.log2(F.greatest(F.col("_size"), F.lit(1)))), F.col("_size") == 0),  # source and size class
    }).withColumn("_p", F.col("_wanted") - F.col("_whole")).drop("_wanted", "_rank")
    order = ["_chunk", "_group", F.col("_a").desc(), "_h"]
    done, schema = [], T.StructType([f for f in x.schema.fields])
    keep = (F.col("_p") > 0) & (F.col("_p") < 1)
    while True:
        x = x.repartition("_chunk", *(["_group"] if done else [])).sortWithinPartitions(*order)
        x = stored(x.mapInArrow(_rounder(_round_run, ["_chunk", "_group"]), schema), "mixed")
        done.append(x.filter(~keep))
        x = x.filter(keep)  # SPARE rows for each chunk, source and size class at most
        if chunks == 1:
            break
        chunks = -(-chunks // FAN)
        x = x.withColumn("_chunk", F.expr(f"_chunk div {FAN}"))
    x = x.withColumn("_group", F.xxhash64(F.col("_source").isNull(), F.col("_source")))
    x = x.repartition("_group").sortWithinPartitions("_group", F.col("_a").desc(), "_h")
    out = x.mapInArrow(_rounder(_settle, ["_group"]), schema)
    for d in done:
        out = out.unionByName(d)
    return out.select(*columns, "_size", "_source_size", "_target", (F.col("_whole") + F.col("_p")).cast("long").alias("_copies"))
