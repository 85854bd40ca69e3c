"""Reconciliation by digests of key ranges against the plain full outer compare."""

import random

from pyspark.sql import functions as F

from ledgerflow.operators import aggregates as ag


def _table(spark, rows):
    return spark.createDataFrame(rows, "k bigint, g string, v double")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_same_rows_as_the_full_compare(spark):
    rnd = random.Random(1)
    a = [(i, rnd.choice("xyz"), rnd.choice([None, float(i), 0.5])) for i in range(3000)]
    b = [r for r in a if rnd.random() > 0.003]
    b = [(k, g, 9.0 if rnd.random() < 0.003 else v) for k, g, v in b] + [(10_000 + i, "n", 1.0) for i in range(5)] + [(None, None, 1.0)]
    x, y = _table(spark, a), _table(spark, b)
    for levels in (1, 2):
        assert _rows(ag.reconcile_by_digest(x, y, ["k", "g"], "v", levels=levels)) == _rows(ag.reconcile(x, y, ["k", "g"], "v", "v"))
    assert _rows(ag.reconcile_by_digest(x, y, ["k", "g"], "v", tol=1e9)) == _rows(ag.reconcile(x, y, ["k", "g"], "v", "v", tol=1e9))


def test_only_differing_ranges_are_compared(spark):
    a = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert ag.differing_ranges(a, a.repartition(3), ["k"], "v").count() == 0
    b = a.withColumn("v", F.when(F.col("k").isin(5, 77), -1).otherwise(F.col("v")))
    assert 1 <= ag.differing_ranges(a, b, ["k"], "v").count() <= 2
    none = a.limit(0)
    assert ag.reconcile_by_digest(none, none, ["k"], "v").count() == 0
    assert {r.status for r in ag.reconcile_by_digest(a.limit(10), none, ["k"], "v").collect()} == {"missing_right"}
