import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerflow.llm import bestfit
from ledgerflow.llm.queries import tokenizer_path
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check_packing(rows, docs, tokenizer, capacity):
    want = collections.Counter()
    for doc, text in docs:
        ids = ids_of(tokenizer, text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at:at + capacity]
            want[(doc, k, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for off, n in sorted(placed):
            assert off == at
            at += n
        assert at <= capacity
    return bins


def best_fit_decreasing(sizes, capacity):
    """One piece at a time: the tightest gap that holds it."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = min((r, i) for i, r in enumerate(rooms) if r >= s) if any(r >= s for r in rooms) else None
        if fit:
            rooms[fit[1]] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_query_places_every_piece_once(spark, tokenizer):
    rows = E.queries()["op6_bestfit"](spark, SF_MID).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    bins = check_packing(rows, docs, tokenizer, 2048)
    sizes = [r.length for r in rows]
    assert len(bins) == best_fit_decreasing(sizes, 2048)
    assert len(bins) <= -(-sum(sizes) // 2048) + 1


def test_odd_rows(spark, tokenizer):
    df = odd_docs(spark)
    rows = bestfit.pack_documents(df, tokenizer_path(), capacity=64).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in df.collect()], tokenizer, 64)


def test_empty_table(spark):
    out = bestfit.pack_documents(empty_docs(spark), tokenizer_path())
    assert out.collect() == [] and "sequence_id" in out.columns


def test_ids_round_trip(spark, tokenizer):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    rows = bestfit.pack_documents(df, tokenizer_path(), capacity=100, with_ids=True).collect()
    got = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    for r in df.collect():
        assert got[r.doc_id] == ids_of(tokenizer, r.text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aàÀİΣσ'sS ,.\n\t\u0301\u00a01", max_size=40))
def test_cached_ids_equal_the_tokenizers(text):
    cache = bestfit.word_ids(tokenizer_path())
    assert np.frombuffer(cache.encode(text), "<u4").tolist() == \
        cache.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_cache_still_gives_the_ids(tokenizer):
    cache = bestfit.WordIds(tokenizer_path(), limit=2)
    text = "some words that, do not. fit in"
    assert np.frombuffer(cache.encode(text), "<u4").tolist() == tokenizer.encode(text).ids
    assert len(cache) <= 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_rounds_equal_best_fit_decreasing(sizes):
    intervals, opened = bestfit.best_fit_rounds(collections.Counter(sizes), 20)
    assert opened == best_fit_decreasing(sizes, 20)
    used = collections.defaultdict(int)
    for (size, n), per in zip(sorted(collections.Counter(sizes).items()), [0] * 99):
        runs = sorted(i for i in intervals if i[0] == size)
        for rank in range(n):
            _, lo, per, first, off = max(i for i in runs if i[1] <= rank)
            used[first + (rank - lo) // per] += size
    assert all(u <= 20 for u in used.values()) and len(used) == opened


def test_hot_length(spark):
    """A third of the pieces of one length spread over sequences by rank."""
    random.seed(1)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text here"))
                                  .otherwise(F.repeat(F.lit("word "), (F.col("id") % 50).cast("int"))).alias("text"))
    rows = bestfit.pack_documents(df, tokenizer_path(), capacity=64).collect()
    total = sum(r.length for r in rows)
    assert len(rows) == 3000 and len({r.sequence_id for r in rows}) <= total // 64 + 2
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
