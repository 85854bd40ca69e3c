"""Percentiles by narrowing brackets; distribution drift."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import aggregates as ag
from ledgerflow.operators import quality as dq


@pytest.mark.parametrize("limit", [60, 100_000])
def test_percentiles_by_brackets_are_exact(spark, limit):
    rnd = random.Random(1)
    groups = {"ties": [rnd.choice([1, 2, 2, 2, 9]) for _ in range(900)], "wide": [rnd.lognormvariate(0, 4) for _ in range(1500)], "one": [7.5], "two": [1.0, 2.0],
              "equal": [3.0] * 400, "hot": [float(rnd.randrange(10 ** 6)) for _ in range(4000)], None: [float(i) for i in range(33)]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("nulls", None)] * 5 + [("hot", None)] * 9
    ps = [0.0, 0.05, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in ag.percentiles_by_brackets(df, ["g"], "v", ps, [f"q{i}" for i in range(6)], bracket_rows=limit).collect()}
    assert got.keys() == {*groups, "nulls"} and all(got["nulls"][f"q{i}"] is None for i in range(6))
    for g, vs in groups.items():
        assert np.allclose([got[g][f"q{i}"] for i in range(6)], np.quantile(vs, ps), rtol=1e-12), g


def test_drift_is_the_total_variation_between_batches(spark):
    rows = [(1, "a", 1), (1, "a", 1), (1, "b", 2), (1, None, 2), (2, "a", 1), (2, "c", None), (4, "c", None)]
    df = spark.createDataFrame(rows, "d int, k string, v int")
    got = {(r.batch, r.column_name): (r.n_rows, r.n_before, r.distance, r.alert) for r in dq.drift(df, F.col("d"), {"k": F.col("k"), "v": F.col("v")}, 0.5).collect()}
    assert got == {(1, "k"): (4, None, None, False), (2, "k"): (2, 4, 0.5, False), (4, "k"): (1, 2, 0.5, False),
                   (1, "v"): (4, None, None, False), (2, "v"): (2, 4, 0.5, False), (4, "v"): (1, 2, 0.5, False)}
    assert dq.drift(df.filter("false"), F.col("d"), {"k": F.col("k")}).collect() == []
