"""The corpus pipeline, stage by stage against brute force on each stage's own
input, and end to end."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from ledgerflow.llm import guesscost, lexicon
from ledgerflow.llm.common import stored, table
from ledgerflow.llm.queries import tokenizer_path
from tests.conftest import SF_MID
from tests.llm import test_bestfit, test_pivotal, test_simhash
from tests.llm.helpers import empty_docs, odd_docs

STAGE = dict(cp.STAGES)


@pytest.fixture(scope="module")
def inputs(spark):
    """What every stage gets, and what the last returns."""
    docs, out = table(spark, SF_MID, "documents"), []
    for name, stage in cp.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, SF_MID), f"test-{name}")
    return {name: (a, b) for (name, _), a, b in zip(cp.STAGES, out, [*out[1:], docs])}


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "secrets", "mix", "pack"] and cp.ORACLE_SQL is None


def test_toxicity_drops_what_it_rejects(spark, inputs):
    docs, kept = inputs["toxicity"]
    score = lexicon.fit(docs, table(spark, SF_MID, "labels")).scorer()
    want = {r.doc_id for r in docs.collect() if score(r.text) < 0.5}
    assert {r.doc_id for r in kept.collect()} == want and 0 < docs.count() - len(want) < 0.25 * docs.count()
    assert kept.schema == docs.schema


def test_near_dedup_keeps_one_of_each_group(inputs):
    docs, kept = inputs["near_dedup"]
    groups = test_simhash.slow_groups({r.doc_id: test_simhash.slow_fingerprint(r.text) for r in docs.collect()})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values())) and kept.columns == docs.columns
    assert len(set(groups.values())) < len(groups)


def test_secrets_are_masked(inputs):
    docs, kept = inputs["secrets"]
    before, after = ({r.doc_id: r for r in d.collect()} for d in (docs, kept))
    assert before.keys() == after.keys() and kept.schema == docs.schema
    for d, r in after.items():
        assert r.text == guesscost.redact(before[d].text) and r.n_chars == len(r.text)
        assert not guesscost.base_spans(r.text) and (r.lang, r.source) == (before[d].lang, before[d].source)
    assert any(after[d].text != before[d].text for d in after)


def test_mix_meets_targets(inputs):
    docs, mixed = inputs["mix"]
    rows = docs.collect()
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += test_pivotal.words(r.text)
    want, taken = test_pivotal.slow_targets(dict(sizes)), collections.Counter()
    for r in rows:
        taken[r.source] += copies[r.doc_id] * test_pivotal.words(r.text)
    assert max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in rows} and mixed.schema == docs.schema
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] for s in sizes)
    by_id = {r.doc_id: r for r in rows}
    assert all(r == by_id[r.doc_id] for r in mixed.collect())


def test_pack_places_every_copy(inputs):
    from tokenizers import Tokenizer
    docs, pieces = inputs["pack"]
    bins = test_bestfit.check_packing(pieces.collect(), [(r.doc_id, r.text) for r in docs.collect()], Tokenizer.from_file(tokenizer_path()), 2048)
    assert len(bins) <= -(-sum(n for b in bins.values() for _, n in b) // 2048) + 1


def test_query_runs_all_stages(spark, inputs):
    got = E.queries()["pipeline"](spark, SF_MID)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    want = inputs["pack"][1]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_near_dedup_of_repeated_rows_and_missing_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "x y z"), (None, "x y z"), (2, "something else entirely"), (3, None), (4, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in STAGE["near_dedup"](spark, docs, SF_MID).collect()), key=str)
    assert kept == sorted([(1, "a b c d"), (2, "something else entirely"), (3, None), (None, "x y z")], key=str)


def test_odd_rows_pass_every_stage(spark):
    docs = odd_docs(spark)
    for name, stage in cp.STAGES[:-1]:
        out = stored(stage(spark, docs, SF_MID), f"odd-{name}")
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        docs = out
    assert STAGE["pack"](spark, docs, SF_MID).count() >= docs.count() > 0


def test_empty_table_passes_every_stage(spark):
    docs = empty_docs(spark).withColumn("extra", F.lit(1))
    for name, stage in cp.STAGES:
        out = stored(stage(spark, docs, SF_MID), f"empty-{name}")
        assert out.count() == 0
        docs = docs if name == "pack" else out
