"""Extreme-value and boundary inputs: empty frames, one row, all NULL, ties,
more buckets than rows, a month gap over a year end. The split window plans
(``max_group_rows=0``) must agree with Spark's native windows here too."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.functions import scalar as sc
from ledgerflow.operators import aggregates as ag
from ledgerflow.operators import business as bz
from ledgerflow.operators import dedup as dd
from ledgerflow.operators import joins as jn
from ledgerflow.operators import quality as dq
from ledgerflow.operators import windows as wn

SCHEMA = "g int, v double, k int"


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "empty": spark.createDataFrame([], SCHEMA),
        "one": spark.createDataFrame([(1, 5.0, 1)], SCHEMA),
        # every row ties on v inside its group
        "ties": spark.createDataFrame([(1, 2.0, i) for i in range(7)] + [(2, 2.0, 10 + i) for i in range(3)], SCHEMA),
        # NULL order values and a NULL group
        "nulls": spark.createDataFrame([(1, None, 1), (1, 3.0, 2), (1, None, 3), (None, 1.0, 4), (None, None, 5)],
                                       SCHEMA),
    }


CASES = ["empty", "one", "ties", "nulls"]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("part", [["g"], []])
def test_row_index_and_ranks(frames, case, part):
    df = frames[case]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy(*part).orderBy("v", "k")))
    got = wn.row_index(df, part, ["v", "k"], "rn", max_group_rows=0, num_chunks=3)
    assert rows(got, ["k", "rn"]) == rows(want, ["k", "rn"])
    w = Window.partitionBy(*part).orderBy("v")
    want = df.withColumn("rank", F.rank().over(w)).withColumn("dense_rank", F.dense_rank().over(w))
    got = wn.rank_columns(df, part, ["v"], ["k"], max_group_rows=0, num_chunks=3)
    assert rows(got, ["k", "rank", "dense_rank"]) == rows(want, ["k", "rank", "dense_rank"])


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("n", [1, 4, 20])
def test_ntile_more_buckets_than_rows(frames, case, n):
    df = frames[case]
    want = df.withColumn("nt", F.ntile(n).over(Window.partitionBy("g").orderBy("v", "k")))
    got = wn.ntile(df, ["g"], ["v", "k"], n, "nt", max_group_rows=0, num_chunks=3)
    assert rows(got, ["k", "nt"]) == rows(want, ["k", "nt"])
    want = df.withColumn("nt", F.ntile(n).over(Window.orderBy("v", "k")))
    got = wn.ntile(df, [], ["v", "k"], n, "nt", num_chunks=2)
    assert rows(got, ["k", "nt"]) == rows(want, ["k", "nt"])


@pytest.mark.parametrize("case", CASES)
def test_distribution_offsets_moving(frames, case):
    df = frames[case]
    w = Window.partitionBy("g").orderBy("v")
    want = df.withColumn("percent_rank", F.percent_rank().over(w)).withColumn("cume_dist", F.cume_dist().over(w))
    got = wn.distribution(df, ["g"], ["v"], ["k"], max_group_rows=0, num_chunks=3)
    assert rows(got, ["k", "percent_rank", "cume_dist"]) == rows(want, ["k", "percent_rank", "cume_dist"])
    cols = ["k", "prev_v", "next_v", "first_v", "last_v"]
    got = wn.offsets(df, ["g"], ["v", "k"], "v", max_group_rows=0, num_chunks=3)
    want = wn.offsets(df, ["g"], ["v", "k"], "v", max_group_rows=10**9)
    assert rows(got, cols) == rows(want, cols)
    got = wn.moving_sum(df, ["g"], ["v", "k"], F.col("v"), 2, "m", max_group_rows=0, num_chunks=3)
    want = wn.moving_sum(df, ["g"], ["v", "k"], F.col("v"), 2, "m", max_group_rows=10**9)
    assert rows(got, ["k", "m", "m_rows"]) == rows(want, ["k", "m", "m_rows"])


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("split", [True, False])
def test_percentiles_match_percentile_cont(frames, case, split):
    df = frames[case]
    got = ag.percentiles(df, ["g"], "v", [0.0, 0.5, 0.9], ["k"], ["p0", "p50", "p90"],
                         max_group_rows=0 if split else None)
    want = df.groupBy("g").agg(*[F.percentile(F.col("v"), p).alias(n)
                                 for p, n in [(0.0, "p0"), (0.5, "p50"), (0.9, "p90")]])
    assert rows(got, ["g", "p0", "p50", "p90"]) == rows(want, ["g", "p0", "p50", "p90"])


def test_all_null_group_keeps_its_row(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, 4.0, 3)], SCHEMA)
    got = {r.g: r.p50 for r in ag.percentiles(df, ["g"], "v", [0.5], ["k"], ["p50"]).collect()}
    assert got == {1: None, 2: 4.0}


def test_mom_over_a_year_end_gap(spark):
    m = spark.createDataFrame([("2023-11-01", 4.0), ("2024-01-01", 2.0), ("2024-02-01", 3.0)],
                              "month string, v double").select(F.to_date("month").alias("month"), "v")
    got = [(str(r.month), r.v, r.prev_v, r.change) for r in bz.mom(m, "v").orderBy("month").collect()]
    assert got == [("2023-11-01", 4.0, None, None), ("2023-12-01", 0.0, 4.0, -1.0),
                   ("2024-01-01", 2.0, 0.0, None), ("2024-02-01", 3.0, 2.0, 0.5)]


def test_mom_empty(spark):
    m = spark.createDataFrame([], "month date, v double")
    assert bz.mom(m, "v").count() == 0


def test_quarter_and_year_edges(spark):
    d = spark.createDataFrame([("2023-12-31",), ("2024-01-01",), ("2024-02-29",), ("2024-03-31",)], "d string") \
             .select(F.to_date("d").alias("d"))
    got = [(str(r.m), str(r.w), r.k) for r in d.select(
        sc.month_start("d").alias("m"), sc.week_start("d").alias("w"),
        sc.months_between_whole(F.lit("2024-03-31").cast("date"), F.col("d")).alias("k")).collect()]
    assert got == [("2023-12-01", "2023-12-25", 3), ("2024-01-01", "2024-01-01", 2),
                   ("2024-02-01", "2024-02-26", 1), ("2024-03-01", "2024-03-25", 0)]


def test_safe_div_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (0.0, 0.0), (6.0, -3.0)], "a double, b double")
    assert [r.q for r in df.select(sc.safe_div("a", "b").alias("q")).collect()] == [None, None, None, None, -2.0]


def test_quality_on_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id int, name string")
    res = dq.evaluate(empty, [dq.not_null("name"), dq.in_range("id", 0, 9)], "t")
    assert {(r.rule, r.failed, r.total) for r in res.collect()} == {("not_null", 0, 0), ("in_range", 0, 0)}
    assert dq.gate_passes(dq.gate(res, 0.0))
    nulls = spark.createDataFrame([(None, None), (None, None)], "id int, name string")
    prof = {r.column_name: (r.n_rows, r.n_null, r.n_distinct, r.min_value, r.max_value)
            for r in dq.profile(nulls).collect()}
    assert prof == {"id": (2, 2, 0, None, None), "name": (2, 2, 0, None, None)}
    assert dq.unique(empty, ["id"], "t").first().asDict() == {
        "table_name": "t", "rule": "unique", "column_name": "id", "failed": 0, "total": 0}


def test_fanout_and_diff_with_an_empty_side(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    e = spark.createDataFrame([], "k int")
    rep = jn.fanout(a, e, "k").first()
    assert rep.joined_rows == 0
    got = {(r.k, r.side, r.copies) for r in ag.diff(a, e).collect()}
    assert got == {(1, "left_only", 2), (2, "left_only", 1)}
    assert ag.diff(e, e).count() == 0


def test_reconcile_nulls_and_tolerance(spark):
    a = spark.createDataFrame([(1, None), (2, 1.0), (3, 1.0), (4, None)], "k int, x double")
    b = spark.createDataFrame([(1, None), (2, 1.004), (3, None), (5, 2.0)], "k int, y double")
    got = {r.k: r.status for r in ag.reconcile(a, b, ["k"], "x", "y", tol=0.01).collect()}
    assert got == {1: "match", 2: "match", 3: "mismatch", 4: "missing_right", 5: "missing_left"}


def test_dedup_on_empty_and_tiny_texts(spark):
    empty = spark.createDataFrame([], "id long, t string")
    assert dd.lev_pairs(empty, "id", F.col("t"), 2).count() == 0
    assert dd.components(spark.createDataFrame([], "u long, v long"),
                         spark.createDataFrame([(7,)], "node long")).collect()[0].asDict() == {"node": 7, "cluster": 7}
    # Short texts differ by a quarter of their length at most; empty ones link with nothing.
    tiny = spark.createDataFrame([(1, ""), (2, "a"), (3, "b"), (4, "abcd"), (5, "abxd"), (6, "a"), (7, ""), (8, "abc")], "id long, t string")
    got = {(r.id_a, r.id_b, r.distance) for r in dd.lev_pairs(tiny, "id", F.col("t"), 2).collect()}
    assert got == {(2, 6, 0), (4, 5, 1)}


def test_components_self_loop_and_one_edge(spark):
    e = spark.createDataFrame([(3, 3), (5, 4)], "u long, v long")
    got = {r.node: r.cluster for r in dd.components(e, spark.createDataFrame([(3,), (4,), (5,)], "node long"))
           .collect()}
    assert got == {3: 3, 4: 4, 5: 4}
