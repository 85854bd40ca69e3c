"""The range-split window plans must equal Spark's native windows.

``max_group_rows=0`` forces the split plan; the hot-key fixture puts a third
of all rows under one key, the case the split exists for."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import aggregates as ag
from ledgerflow.operators import windows as wn
from ledgerflow.sources.tables import load
from tests.conftest import SF_SMALL


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: [(x is None, x) if x is not None else (True, 0) for x in t])


@pytest.fixture(scope="module")
def orders(spark):
    o = load(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    # One hot customer holding a third of the orders.
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))


def test_hot_key_is_split_over_chunks(orders):
    x = wn._split(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 6)
    hot_chunks = x.filter(F.col("o_custkey") == -1).select("_chunk").distinct().count()
    assert hot_chunks > 1


@pytest.mark.parametrize("chunks", [3, 7])
def test_row_index_split_equals_row_number(orders, chunks):
    order = ["o_orderdate", "o_orderkey"]
    got = wn.row_index(orders, ["o_custkey"], order, "rn", max_group_rows=0, num_chunks=chunks)
    want = orders.withColumn("rn", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order)))
    assert rows(got, ["o_orderkey", "rn"]) == rows(want, ["o_orderkey", "rn"])


def test_global_row_index(orders):
    got = wn.row_index(orders, [], ["o_totalprice", "o_orderkey"], "rn", num_chunks=5)
    want = orders.withColumn("rn", F.row_number().over(Window.orderBy("o_totalprice", "o_orderkey")))
    assert rows(got, ["o_orderkey", "rn"]) == rows(want, ["o_orderkey", "rn"])


def test_rank_columns_split(orders):
    o = orders.withColumn("price_band", F.floor(F.col("o_totalprice") / 50000))
    got = wn.rank_columns(o, ["o_custkey"], ["price_band"], ["o_orderkey"], descending=True,
                          max_group_rows=0, num_chunks=4)
    want = wn.rank_columns(o, ["o_custkey"], ["price_band"], ["o_orderkey"], descending=True,
                           max_group_rows=10**9)
    cols = ["o_orderkey", "row_number", "rank", "dense_rank"]
    assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("part", [["o_custkey"], []])
def test_ntile_split(orders, part):
    order = ["o_totalprice", "o_orderkey"]
    got = wn.ntile(orders, part, order, 7, "nt", max_group_rows=0, num_chunks=4)
    w = Window.partitionBy(*part).orderBy(*order) if part else Window.orderBy(*order)
    want = orders.withColumn("nt", F.ntile(7).over(w))
    assert rows(got, ["o_orderkey", "nt"]) == rows(want, ["o_orderkey", "nt"])


def test_distribution_split(orders):
    o = orders.withColumn("band", F.floor(F.col("o_totalprice") / 100000))
    got = wn.distribution(o, ["o_custkey"], ["band"], ["o_orderkey"], max_group_rows=0, num_chunks=4)
    want = wn.distribution(o, ["o_custkey"], ["band"], ["o_orderkey"], max_group_rows=10**9)
    cols = ["o_orderkey", "percent_rank", "cume_dist"]
    g = [(a, round(b, 12), round(c, 12)) for a, b, c in rows(got, cols)]
    w = [(a, round(b, 12), round(c, 12)) for a, b, c in rows(want, cols)]
    assert g == w


def test_offsets_split(orders):
    order = ["o_orderdate", "o_orderkey"]
    got = wn.offsets(orders, ["o_custkey"], order, "o_totalprice", max_group_rows=0, num_chunks=5)
    want = wn.offsets(orders, ["o_custkey"], order, "o_totalprice", max_group_rows=10**9)
    cols = ["o_orderkey", "prev_o_totalprice", "next_o_totalprice", "first_o_totalprice", "last_o_totalprice"]
    assert rows(got, cols) == rows(want, cols)


def test_running_and_moving_split(orders):
    order = ["o_orderdate", "o_orderkey"]
    o = orders.withColumn("v", F.col("o_totalprice").cast("decimal(18,2)"))
    got = wn.prefix_sums(o, ["o_custkey"], order, {"run": F.col("v")}, max_group_rows=0, num_chunks=5)
    got = wn.moving_sum(got, ["o_custkey"], order, F.col("v"), 3, "mv", max_group_rows=0, num_chunks=4)
    want = wn.prefix_sums(o, ["o_custkey"], order, {"run": F.col("v")}, max_group_rows=10**9)
    want = wn.moving_sum(want, ["o_custkey"], order, F.col("v"), 3, "mv", max_group_rows=10**9)
    cols = ["o_orderkey", "run", "mv", "mv_rows"]
    assert rows(got, cols) == rows(want, cols)


def test_percentiles_split_matches_exact(orders):
    got = ag.percentiles(orders, ["o_custkey"], "o_totalprice", [0.5, 0.9], ["o_orderkey"], ["p50", "p90"],
                         max_group_rows=0)
    want = orders.groupBy("o_custkey").agg(F.percentile("o_totalprice", 0.5).alias("p50"),
                                           F.percentile("o_totalprice", 0.9).alias("p90"))
    g = {r.o_custkey: (round(r.p50, 6), round(r.p90, 6)) for r in got.collect()}
    w = {r.o_custkey: (round(r.p50, 6), round(r.p90, 6)) for r in want.collect()}
    assert g == w


def test_sampled_hot_group_check(spark):
    from tests.conftest import SF_MID
    o = load(spark, SF_MID, "orders").select("o_orderkey", "o_custkey")
    hot = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))
    n_hot = wn.largest_group(hot, ["o_custkey"])
    est = wn.largest_group_estimate(hot, ["o_custkey"], 8_000)   # samples a quarter of the rows
    assert abs(est - n_hot) < 0.1 * n_hot
    assert wn.needs_split(hot, ["o_custkey"], 8_000)
    assert not wn.needs_split(o, ["o_custkey"], 8_000)


def test_split_sums_of_nulls_doubles_and_types(spark):
    """Values with gaps, magnitudes 1e16 apart, and the plain plan's types,
    one row to a block where blocks exist."""
    vals = [1.0, 2.0, 3.0, None, None, None, None, 8.0, 1e16, 1.0, 2.0, 3.0, None, -1e16, 0.5]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)] + [("b", i, None) for i in range(5)], "g string, k int, v double")
    df = df.withColumn("d", (F.when(F.abs("v") < 1e9, F.col("v"))).cast("decimal(18,2)")).withColumn("n", F.col("v").cast("bigint"))
    wn_block, wn.BLOCK_ROWS = wn.BLOCK_ROWS, 4
    try:
        for col in ("v", "d", "n"):
            split = wn.moving_sum(df, ["g"], ["k"], F.col(col), 2, "m", max_group_rows=0, num_chunks=5)
            plain = wn.moving_sum(df, ["g"], ["k"], F.col(col), 2, "m", max_group_rows=10**9)
            assert rows(split, ["g", "k", "m", "m_rows"]) == rows(plain, ["g", "k", "m", "m_rows"])
            assert split.schema["m"].dataType == plain.schema["m"].dataType
        for col in ("d", "n"):
            split = wn.prefix_sums(df, ["g"], ["k"], {"s": F.col(col)}, max_group_rows=0, num_chunks=5)
            plain = wn.prefix_sums(df, ["g"], ["k"], {"s": F.col(col)}, max_group_rows=10**9)
            assert sorted(map(str, split.select("g", "k", "s").collect())) == sorted(map(str, plain.select("g", "k", "s").collect()))
            assert split.schema["s"].dataType == plain.schema["s"].dataType
    finally:
        wn.BLOCK_ROWS = wn_block
    # Doubles: a running sum is the same up to the rounding of its largest term.
    small = df.filter(F.col("v").isNull() | (F.abs("v") < 1e9))
    s, p = (dict((tuple(r)[:2], r.s) for r in wn.prefix_sums(small, ["g"], ["k"], {"s": F.col("v")}, max_group_rows=m, num_chunks=5).select("g", "k", "s").collect())
            for m in (0, 10**9))
    assert s.keys() == p.keys() and all((s[k] is None) == (p[k] is None) and (s[k] is None or abs(s[k] - p[k]) < 1e-9) for k in s)


def test_offsets_by_n(orders):
    order = ["o_orderdate", "o_orderkey"]
    w = Window.partitionBy("o_custkey").orderBy(*order)
    want = orders.withColumn("prev_o_totalprice", F.lag("o_totalprice", 3).over(w)).withColumn("next_o_totalprice", F.lead("o_totalprice", 3).over(w))
    for limit in (0, 10**9):
        got = wn.offsets(orders, ["o_custkey"], order, "o_totalprice", max_group_rows=limit, num_chunks=4, n=3)
        cols = ["o_orderkey", "prev_o_totalprice", "next_o_totalprice"]
        key = lambda t: [(x is None, x or 0) for x in t]
        assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted((tuple(r) for r in want.select(*cols).collect()), key=key)
