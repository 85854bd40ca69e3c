"""State that batches merge into: cohort months, distinct bitmaps, clusters."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import business as bz
from ledgerflow.operators import dedup as dd
from tests import brute


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cohort_of_merged_batches_equals_one_run(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(50), dt.datetime(1969, 1, 5) + dt.timedelta(days=rnd.randrange(9000))) for _ in range(900)] + [(3, None), (None, dt.datetime(1970, 5, 1))]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz").withColumn("k", F.pmod(F.xxhash64("u", "ts"), F.lit(4)))
    whole = _rows(bz.cohort(df.filter("ts is not null"), "u", "ts"))
    state = bz.month_bits(df.filter("k = 0"), "u", "ts")
    for batch in ("k = 1", "k = 1", "k in (0, 2)", "k = 3"):  # one comes twice, one overlaps
        state = bz.merge_month_bits(state, bz.month_bits(df.filter(batch), "u", "ts"))
    assert _rows(bz.cohort_from_bits(state)) == whole == _rows(bz.cohort_from_bits(bz.month_bits(df, "u", "ts")))


@pytest.mark.parametrize("wide", [50, 200_000])
def test_distinct_rollup_equals_count_distinct(spark, wide):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice("xyz"), rnd.choice([None, rnd.randrange(-wide, wide)])) for _ in range(800)] + [("c", "only null", None)]
    df = spark.createDataFrame(rows, "g string, h string, v int")
    want = df.rollup("g", "h").agg((F.grouping("g") + F.grouping("h")).cast("int").alias("level"), F.countDistinct("v").alias("n"))
    bits = bz.distinct_bitmaps(df, ["g", "h"], "v")
    assert _rows(bz.distinct_rollup(bits, ["g", "h"], "n")) == _rows(want.select("g", "h", "level", "n"))
    halves = [bz.distinct_bitmaps(df.filter(c), ["g", "h"], "v") for c in ("coalesce(v, 1) % 2 = 0", "coalesce(v, 1) % 2 <> 0", "v > 0")]
    merged = bz.merge_bitmaps(halves[0].unionByName(halves[1]).unionByName(halves[2]), ["g", "h"])
    assert _rows(bz.distinct_rollup(merged, ["g", "h"], "n")) == _rows(want.select("g", "h", "level", "n"))


def test_updated_clusters_equal_a_full_run(spark):
    rnd = random.Random(3)
    nodes = list(range(300))
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(40, 80)]
    rnd.shuffle(edges)
    frame = lambda e: spark.createDataFrame(e, "u bigint, v bigint")
    labels = dd.components(frame(edges[:80]))
    for i in (80, 120, 160):
        labels = dd.update_components(labels, frame(edges[i:i + 40])).checkpoint()
    labels = dd.update_components(labels, frame(edges[200:]), spark.createDataFrame([(n,) for n in nodes], "node bigint"))
    got = {r.node: r.cluster for r in labels.collect()}
    assert got == brute.components(nodes, edges) and labels.count() == len(nodes)
    same = dd.update_components(labels, frame([]))
    assert {r.node: r.cluster for r in same.collect()} == got
