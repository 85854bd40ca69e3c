"""Modelling checks (NF-1..5) and data layout for pruning (LY-1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import diff


# --- NF-1 --------------------------------------------------------------------
def to_1nf(df: DataFrame, key: Sequence[str], col: str, sep_regex: str, out: str = "value") -> DataFrame:
    """Split a multi-valued column into child rows (key, pos, value); pos is
    0-based. Whole values are split, trailing empty parts included."""
    return df.select(*key, F.posexplode(F.split(F.col(col), sep_regex, -1)).alias("pos", out))


# --- NF-2 --------------------------------------------------------------------
def check_fd(df: DataFrame, x: Sequence[str], y: Sequence[str]) -> DataFrame:
    """Violations of the functional dependency X -> Y: every X value with
    more than one distinct Y (NULL is a value: compared as a struct).

    De-duplicating (X, Y) first is a partial aggregate, so a hot X value is
    reduced map-side before the count."""
    pairs = df.select(*x, F.struct(*y).alias("_y")).distinct()
    return pairs.groupBy(*x).agg(F.count(F.lit(1)).alias("n_values")).filter(F.col("n_values") > 1)


# --- NF-3 --------------------------------------------------------------------
#: Distinct rows that a task holds, about, however many there are in all.
ROWS_AT_ONCE = 250_000


def decompose(wide: DataFrame, spec: dict[str, Sequence[str]], keys: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Project ``wide``, a written table, onto each table's columns (distinct
    rows). A table of many distinct rows is dealt over tasks in proportion to
    these, by its columns or by its key, if known: left to itself, Spark deals it over the
    cores by its small shuffled bytes, and a task's hash map grows with the
    input. Other tables are combined before they move."""
    keys = keys or {}
    n = wide.agg(*[F.approx_count_distinct(F.xxhash64(*cols)).alias(f"n{i}") for i, cols in enumerate(spec.values())]).first()
    out = {}
    for i, (name, cols) in enumerate(spec.items()):
        x, tasks = wide.select(*cols), -(-n[f"n{i}"] // ROWS_AT_ONCE)
        if tasks > wide.sparkSession.sparkContext.defaultParallelism:
            x = x.repartition(tasks, *keys.get(name, cols))
        out[name] = x.distinct()
    return out


def lossless_check(wide: DataFrame, parts: dict[str, DataFrame], join_order: Sequence[tuple[str, Sequence[str]]],
                   wide_is_distinct: bool = False) -> DataFrame:
    """Rejoin the parts in ``join_order`` ((table, join keys) pairs; the first
    keys list is ignored) and compare with the distinct wide rows, both ways.
    Returns (side, copies) rows; empty = lossless. ``wide_is_distinct``
    skips de-duplicating rows the caller already made distinct."""
    first, _ = join_order[0]
    r = parts[first]
    for name, keys in join_order[1:]:
        r = r.join(parts[name], list(keys))
    cols = wide.columns
    w = wide if wide_is_distinct else wide.dropDuplicates()
    return diff(w.select(*cols), r.select(*cols))


def lossless_by_keys(parts: dict[str, DataFrame], join_order: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """(part, n_rows, repeated_keys, null_keys): Heath's theorem as a check. A
    part joined on columns that are unique in it repeats no row, and
    projections of one table lose none as long as no join column is NULL,
    which an equi-join drops. So a split whose parts all have unique join keys
    without NULLs is lossless. One aggregate per joined part, which counts its
    rows too; no wide rows are rebuilt. A non-zero count says nothing by
    itself: compare rows (``lossless_check``)."""
    out = None
    for name, keys in join_order[1:]:
        some_null = reduce(lambda p, q: p | q, [F.col(k).isNull() for k in keys])
        per_key = parts[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        one = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
                          F.count_if(F.col("_n") > 1).cast("bigint").alias("repeated_keys"),
                          F.count_if(some_null).cast("bigint").alias("null_keys")).select(F.lit(name).alias("part"), "n_rows", "repeated_keys", "null_keys")
        out = one if out is None else out.unionByName(one)
    return out


def key_counts(part: DataFrame, key: Sequence[str]) -> DataFrame:
    """(n_rows, repeated_keys) of one part's distinct rows: all rows, and
    those beyond the first of their key; none if the key is all columns."""
    per_key = part.select(F.lit(1).alias("_n")) if set(key) == set(part.columns) else part.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("repeated_keys"))


# --- NF-4 --------------------------------------------------------------------
def candidate_keys(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """(key_set, n_distinct, n_rows, is_key) for each column set: one pruned
    scan and one shuffle of its own columns per set, rows counted with the
    keys (several distinct counts in one aggregate would copy every row once
    per set before the shuffle)."""
    out = None
    for s in sets:
        per_key = df.groupBy(*s).agg(F.count(F.lit(1)).alias("_n"))
        one = per_key.agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                          F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"))
        one = one.select(F.lit(",".join(s)).alias("key_set"), "n_distinct", "n_rows",
                         (F.col("n_distinct") == F.col("n_rows")).alias("is_key"))
        out = one if out is None else out.unionByName(one)
    return out


# --- LY-1 --------------------------------------------------------------------
def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str]) -> None:
    """Partitioned, sorted layout: readers filtering on ``partition_by`` skip
    whole directories; sorting inside files tightens row-group min/max so
    range filters on ``sort_by`` skip row groups.

    ``rebalance`` (not ``repartition(col)``) lets AQE split a hot partition
    value over several tasks instead of writing it from one.
    """
    (df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))
