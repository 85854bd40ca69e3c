"""Joins and grain (JN-1..8). No side is broadcast by hint: Spark chooses by
size, AQE at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


# --- JN-3 --------------------------------------------------------------------
def not_in(left: DataFrame, col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows of ``left`` whose ``col NOT IN (SELECT right_col FROM right)`` is
    true: none if the subquery holds a NULL, all if it is empty."""
    keys = right.select(F.col(right_col).alias("_not_in"))
    seen = keys.agg(F.count(F.lit(1)).alias("n"), F.count("_not_in").alias("known")).first()
    if seen["n"] == 0:
        return left
    if seen["known"] < seen["n"]:
        return left.limit(0)
    out = left.filter(F.col(col).isNotNull())
    return out.join(keys.distinct(), out[col] == F.col("_not_in"), "left_anti")


# --- JN-6 --------------------------------------------------------------------
def check_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once, with their multiplicity ``n``.

    One partial+final aggregate; a hot key is combined map-side first.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


# --- JN-7 --------------------------------------------------------------------
def fanout(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """One-row report for the planned join ``left ⋈ right`` on ``on``,
    computed from per-key counts only (the join itself never runs).

    Columns: left_rows, right_rows, joined_rows, max_left_per_key,
    max_right_per_key, relation ('1:1', '1:N', 'N:1', 'N:M', 'empty').
    NULL keys never match, as in an equi-join.
    """
    keys = _keys(on)
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))
    # Full outer join of the two count tables: NULL keys never match, so they
    # stay one-sided and add to the side totals only.
    both = F.col("_nl").isNotNull() & F.col("_nr").isNotNull()
    rep = lc.join(rc, keys, "full_outer").agg(
        F.coalesce(F.sum("_nl"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum("_nr"), F.lit(0)).cast("bigint").alias("right_rows"),
        F.coalesce(F.sum(F.when(both, F.col("_nl") * F.col("_nr"))), F.lit(0)).cast("bigint").alias("joined_rows"),
        F.coalesce(F.max(F.when(both, F.col("_nl"))), F.lit(0)).cast("bigint").alias("max_left_per_key"),
        F.coalesce(F.max(F.when(both, F.col("_nr"))), F.lit(0)).cast("bigint").alias("max_right_per_key"),
    )
    rel = (F.when(F.col("joined_rows") == 0, "empty")
           .when((F.col("max_left_per_key") <= 1) & (F.col("max_right_per_key") <= 1), "1:1")
           .when(F.col("max_left_per_key") <= 1, "1:N")
           .when(F.col("max_right_per_key") <= 1, "N:1")
           .otherwise("N:M"))
    return rep.withColumn("relation", rel)


# --- JN-8 --------------------------------------------------------------------
def safe_join(one: DataFrame, many: DataFrame, on, aggs: Sequence, how: str = "left") -> DataFrame:
    """Join ``many`` at the grain of ``one``: aggregate ``many`` to the join
    key first (partial aggregation, no fan-out), then join."""
    keys = _keys(on)
    return one.join(many.groupBy(*keys).agg(*aggs), keys, how)


# --- JN-5 --------------------------------------------------------------------
def successive_pairs(df: DataFrame, partition_by: Sequence[str], seq_col: str,
                     residual=None, suffixes=("", "_prev")) -> DataFrame:
    """Self join of each row to its predecessor in the same group.

    ``seq_col`` is a dense 1-based position within ``partition_by`` (see
    ``windows.row_index``). The join key ``(partition_by, seq)`` is unique on
    both sides, so a hot group spreads over all reducers and the output has
    at most one row per input row. ``residual`` is an extra (inequality)
    predicate over the two aliased sides ``cur`` and ``prev``.
    """
    cur = df.alias("cur")
    prev = df.alias("prev")
    cond = [F.col(f"cur.{k}") == F.col(f"prev.{k}") for k in partition_by]
    cond.append(F.col(f"cur.{seq_col}") == F.col(f"prev.{seq_col}") + 1)
    pred = cond[0]
    for c in cond[1:]:
        pred = pred & c
    if residual is not None:
        pred = pred & residual
    return cur.join(prev, pred, "inner")
