"""Window functions (WN-1..7) that never put a whole group in one task.

A plain ``Window.partitionBy(k)`` sends every row of a key to one task. When
one key may hold a third of the table that task is the whole job. The
functions here first estimate the largest group (a sampled partial
aggregate over the key columns). Below ``max_group_rows`` they use the
ordinary window. Above it they use a *range-split* plan with the same rows
and the same column types (running sums of doubles may differ in the last
digits, as any distributed sum does; sum decimals where that matters):

1. ``repartitionByRange(n, *partition_by, *order_by)`` cuts the frame into
   ``n`` contiguous ranges of the composite ordering, so a hot group is spread
   over many chunks. The chunk id is materialised with ``checkpoint()`` in the
   shared checkpoint folder, so a lost executor cannot re-sample other
   bounds.
2. Each ``(group, chunk)`` runs the window locally (bounded by chunk size).
3. Per ``(group, chunk)`` totals are prefix-summed over chunks. Only a group
   that crosses a chunk boundary gets a non-zero offset, and each boundary
   splits at most one group, so the offset table has fewer than ``n`` rows:
   a proven bound, so it is broadcast.

Everything that depends on order (row number, rank, ntile, running and
moving sums, lag/lead) is derived from prefix sums and equi-joins on the
unique key ``(group, row_number)``, which hash-distributes evenly however
hot a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, keep

# Largest group one task may sort in a plain window.
MAX_GROUP_ROWS = 4_000_000
# Target rows per chunk of the range split.
CHUNK_ROWS = 2_000_000
# Rows of a block in the split plan of moving frames.
BLOCK_ROWS = 500_000
# Sampled rows expected from a group of MAX_GROUP_ROWS in the hot-group check.
HOT_SAMPLE_ROWS = 2_000
HOT_SAMPLE_SEED = 17


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in (xs or [])]


def join_back(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join of ``right`` (usually an aggregate of ``left``)
    back onto ``left``. The right side's key columns are renamed first, so a
    right side derived from ``left`` never makes a reference ambiguous; the
    result has ``left``'s columns plus ``right``'s non-key columns."""
    keys = list(keys)
    r = right.select(*[F.col(c).alias(f"__k{i}") if c in keys else F.col(c)
                       for i, c in enumerate(right.columns)])
    ren = {c: f"__k{i}" for i, c in enumerate(right.columns) if c in keys}
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[ren[k]])
    return left.join(r, cond, how).drop(*ren.values())


def largest_group(df: DataFrame, partition_by: Sequence[str]) -> int:
    """Rows in the largest group, exact (one partial + final aggregate)."""
    if not partition_by:
        return df.count()
    r = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return int(r or 0)


def largest_group_estimate(df: DataFrame, partition_by: Sequence[str], limit: int) -> int:
    """Estimated rows in the largest group, from a Bernoulli sample that
    keeps about ``HOT_SAMPLE_ROWS`` rows of a group of ``limit`` rows.

    The exact count shuffles one partial count per distinct key and task,
    as large as the input when keys are nearly unique; the sample shuffles
    about ``HOT_SAMPLE_ROWS / limit`` of it and still reads only the key
    columns. A group of ``limit`` rows yields ~2,000 sampled rows (standard
    deviation ~45), so it is not missed; the choice only picks the faster
    plan, both plans give the same rows.
    """
    frac = HOT_SAMPLE_ROWS / max(limit, 1)
    if frac >= 0.5:
        return largest_group(df, partition_by)
    r = (df.select(*_cols(partition_by)).sample(fraction=frac, seed=HOT_SAMPLE_SEED)
         .groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0])
    return int((r or 0) / frac)


def needs_split(df: DataFrame, partition_by: Sequence[str], max_group_rows: int | None) -> bool:
    limit = MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    if not partition_by:
        return True  # a global order always goes through the range split
    # Split when the sample says the largest group may reach half the limit
    # (a margin for sampling error; splitting a smaller group is only slower).
    return largest_group_estimate(df, partition_by, limit) > limit // 2


def _split(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, num_chunks: int | None,
           rows: int | None = None) -> DataFrame:
    """Range-partition into chunks of about ``CHUNK_ROWS`` rows (at least the
    shuffle partition count), so chunk size stays bounded as data grows.
    ``rows`` is the row count, if the caller has it."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_chunks
    if n is None:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(df.count() if rows is None else rows) // CHUNK_ROWS))
    ranged = df.repartitionByRange(n, *_cols(partition_by), *_cols(order_by))
    return ranged.withColumn("_chunk", F.spark_partition_id()).checkpoint(eager=True)


def prefix_sums(df: DataFrame, partition_by: Sequence[str], order_by: Sequence,
                values: dict[str, Column], max_group_rows: int | None = None,
                num_chunks: int | None = None, rows: int | None = None) -> DataFrame:
    """Add inclusive running sums of ``values`` within ``partition_by`` in
    ``order_by`` order. ``order_by`` must be unique within a group (end it in
    a key). ``{"rn": F.lit(1)}`` gives the row number."""
    P = list(partition_by or [])
    if not needs_split(df, P, max_group_rows):
        w = (Window.partitionBy(*P).orderBy(*_cols(order_by))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = df
        for name, v in values.items():
            out = out.withColumn(name, F.sum(v).over(w))
        return out

    x = _split(df, P, order_by, num_chunks, rows)
    w = (Window.partitionBy(*P, "_chunk").orderBy(*_cols(order_by))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The plain plan's types; a sum is NULL only until the first value.
    types = df.select(*[F.sum(v).alias(k) for k, v in values.items()]).schema
    for name, v in values.items():
        x = x.withColumn(name, F.sum(v).over(w))
    # Totals per (group, chunk); offsets = totals of earlier chunks of the
    # same group. Non-zero only for groups crossing a boundary (< n rows).
    totals = x.groupBy(*P, "_chunk").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in values.items()])
    wo = Window.partitionBy(*P).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*P, "_chunk", F.count(F.lit(1)).over(wo).alias("_before"),
                         *[F.sum(f"_t_{k}").over(wo).alias(f"_o_{k}") for k in values])
    offs = F.broadcast(offs.filter(F.col("_before") > 0).drop("_before"))
    joined = join_back(x, offs, P + ["_chunk"], "left")
    sel = [F.col(c) for c in df.columns]
    for k in values:
        both = F.coalesce(F.col(k) + F.col(f"_o_{k}"), F.col(k), F.col(f"_o_{k}"))
        sel.append(both.cast(types[k].dataType).alias(k))
    return joined.select(*sel)


def _global_index(df: DataFrame, order_by: Sequence, out: str, num_chunks: int | None, rows: int | None) -> DataFrame:
    """Row number over the whole frame with one shuffle: rows are
    range-partitioned, sorted and written once with their place in their
    partition; the partitions' row counts (one number each) give the places
    before them. The written table pins the ranges."""
    spark = df.sparkSession
    n = num_chunks
    if n is None:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(df.count() if rows is None else rows) // CHUNK_ROWS))
    order = _cols(order_by)
    x = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    x = keep(x, "global-index")
    part = F.shiftright("_place", 33)
    offsets, before = [], 0
    for r in sorted(x.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((r["p"], before))
        before += r["n"]
    offs = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _before bigint"))  # a row per partition
    x = x.withColumn("_part", part).join(offs, "_part")
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return x.select(*df.columns, (F.col("_before") + place + 1).alias(out))


def row_index(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, out: str = "rn",
              max_group_rows: int | None = None, num_chunks: int | None = None, rows: int | None = None) -> DataFrame:
    """WN-1 ``row_number`` (bigint, 1-based) without a single-task group."""
    P = list(partition_by or [])
    if not needs_split(df, P, max_group_rows):
        w = Window.partitionBy(*P).orderBy(*_cols(order_by))
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if not P:
        return _global_index(df, order_by, out, num_chunks, rows)
    r = prefix_sums(df, P, order_by, {out: F.lit(1).cast("bigint")}, max_group_rows=0,
                    num_chunks=num_chunks, rows=rows)
    return r.withColumn(out, F.col(out).cast("bigint"))


def rank_columns(df: DataFrame, partition_by: Sequence[str], order_values: Sequence[str],
                 tiebreak: Sequence[str], descending: bool = False,
                 max_group_rows: int | None = None, num_chunks: int | None = None) -> DataFrame:
    """WN-1 ``row_number``, ``rank``, ``dense_rank`` over ``order_values``.

    ``rank`` = smallest row number among equal values; ``dense_rank`` = row
    number of the value among distinct values. Both are aggregates joined
    back on ``(group, value)``; AQE splits a hot value on the join.
    """
    P = list(partition_by or [])
    ov = list(order_values)
    def order(cs):
        return [F.col(c).desc() if descending else F.col(c).asc() for c in cs]
    if not needs_split(df, P, max_group_rows):
        w = Window.partitionBy(*P).orderBy(*order(ov))
        wt = Window.partitionBy(*P).orderBy(*order(ov), *[F.col(t).asc() for t in tiebreak])
        return (df.withColumn("row_number", F.row_number().over(wt).cast("bigint"))
                  .withColumn("rank", F.rank().over(w).cast("bigint"))
                  .withColumn("dense_rank", F.dense_rank().over(w).cast("bigint")))
    ranked = row_index(df, P, order(ov) + [F.col(t).asc() for t in tiebreak], "row_number",
                       max_group_rows=0, num_chunks=num_chunks)
    firsts = ranked.groupBy(*P, *ov).agg(F.min("row_number").alias("rank"))
    dense = row_index(firsts.select(*P, *ov), P, order(ov), "dense_rank",
                      max_group_rows=max_group_rows, num_chunks=num_chunks)
    ties = join_back(firsts, dense, P + ov)
    out = join_back(ranked, ties, P + ov)
    return out.withColumn("rank", F.col("rank").cast("bigint")).withColumn(
        "dense_rank", F.col("dense_rank").cast("bigint"))


def _group_counts(df: DataFrame, P: Sequence[str], out: str) -> DataFrame:
    return df.groupBy(*P).agg(F.count(F.lit(1)).alias(out))


def ntile_from_rn(rn: Column, cnt: Column, n: int) -> Column:
    """SQL ``ntile(n)`` from a 1-based row number and the group size: the
    first ``cnt % n`` buckets hold one extra row."""
    q = F.floor(cnt / n)
    r = cnt - q * n
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rn - big - 1) / q) + 1).cast("int")


def ntile(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, n: int,
          out: str = "ntile", max_group_rows: int | None = None,
          num_chunks: int | None = None, rows: int | None = None) -> DataFrame:
    """WN-5 / WN-7 exact ``ntile(n)``; with no ``partition_by`` this is the
    global ntile that a plain window would run in a single partition.
    ``rows`` is the row count of ``df``, if the caller has it."""
    P = list(partition_by or [])
    if P and not needs_split(df, P, max_group_rows):
        return df.withColumn(out, F.ntile(n).over(Window.partitionBy(*P).orderBy(*_cols(order_by))))
    rows = df.count() if rows is None and not P else rows
    r = row_index(df, P, order_by, "_rn", max_group_rows=0, num_chunks=num_chunks, rows=rows)
    if P:
        r = join_back(r, _group_counts(df, P, "_cnt"), P)
    else:
        r = r.withColumn("_cnt", F.lit(rows))
    return r.withColumn(out, ntile_from_rn(F.col("_rn"), F.col("_cnt"), n)).drop("_rn", "_cnt")


def distribution(df: DataFrame, partition_by: Sequence[str], order_values: Sequence[str],
                 tiebreak: Sequence[str], max_group_rows: int | None = None,
                 num_chunks: int | None = None) -> DataFrame:
    """WN-5 ``percent_rank`` and ``cume_dist`` (doubles)."""
    P = list(partition_by or [])
    if P and not needs_split(df, P, max_group_rows):
        w = Window.partitionBy(*P).orderBy(*order_values)
        return (df.withColumn("percent_rank", F.percent_rank().over(w))
                  .withColumn("cume_dist", F.cume_dist().over(w)))
    r = rank_columns(df, P, order_values, tiebreak, max_group_rows=0, num_chunks=num_chunks)
    last = r.groupBy(*P, *order_values).agg(F.max("row_number").alias("_upto"))
    j = join_back(r, last, P + list(order_values))
    if P:
        j = join_back(j, _group_counts(df, P, "_cnt"), P)
    else:
        j = j.withColumn("_cnt", F.lit(df.count()))
    return (j.withColumn("percent_rank", F.when(F.col("_cnt") > 1,
                                                (F.col("rank") - 1) / (F.col("_cnt") - 1)).otherwise(F.lit(0.0)))
             .withColumn("cume_dist", F.col("_upto") / F.col("_cnt"))
             .drop("_upto", "_cnt", "row_number", "rank", "dense_rank"))


def shifted(df: DataFrame, partition_by: Sequence[str], rn_col: str, cols: Sequence[str],
            k: int, prefix: str) -> DataFrame:
    """lag (k > 0) / lead (k < 0) by an equi-join on the unique key
    ``(group, row_number)``; no ordering work and no skew."""
    P = list(partition_by or [])
    other = df.select(*P, (F.col(rn_col) + k).alias(rn_col), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return join_back(df, other, P + [rn_col], "left")


def moving_sum(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, value: Column,
               n: int, out: str, max_group_rows: int | None = None,
               num_chunks: int | None = None) -> DataFrame:
    """WN-3 sum over ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW`` plus the
    number of rows in the frame (``{out}_rows``).

    Split plan: rows are numbered, a group is cut into blocks of consecutive
    numbers, each block also gets the n-1 rows before it, and Spark's own
    frame runs inside the block. No prefix is ever subtracted, so NULLs and
    doubles come out as in the plain plan."""
    P = list(partition_by or [])
    if P and not needs_split(df, P, max_group_rows):
        w = Window.partitionBy(*P).orderBy(*_cols(order_by)).rowsBetween(-(n - 1), 0)
        return (df.withColumn(out, F.sum(value).over(w))
                  .withColumn(f"{out}_rows", F.count(F.lit(1)).over(w)))
    r = row_index(df.withColumn("_v", value), P, order_by, "_rn", max_group_rows=0, num_chunks=num_chunks)
    size = max(BLOCK_ROWS, n)
    own = F.expr(f"(_rn - 1) div {size}")
    # A block's last n-1 rows are needed by the next block's first frames.
    r = r.withColumn("_own", own).withColumn(
        "_block", F.explode(F.array_distinct(F.array("_own", F.expr(f"(_rn + {n - 2}) div {size}")))))
    w = Window.partitionBy(*P, "_block").orderBy("_rn").rowsBetween(-(n - 1), 0)
    r = r.withColumn(out, F.sum("_v").over(w)).withColumn(f"{out}_rows", F.count(F.lit(1)).over(w))
    return r.filter(F.col("_block") == F.col("_own")).select(*df.columns, out, f"{out}_rows")


def offsets(df: DataFrame, partition_by: Sequence[str], order_asc: Sequence[str], col: str,
            max_group_rows: int | None = None, num_chunks: int | None = None, n: int = 1) -> DataFrame:
    """WN-2 ``lag``/``lead`` by ``n`` rows and ``first_value``/``last_value``
    over the whole group (columns ``prev_``, ``next_``, ``first_``, ``last_``).

    Split plan: lag/lead are equi-joins on ``(group, row_number ± n)``;
    first/last are ``min_by``/``max_by`` aggregates (combined map-side)
    joined back on the group.
    """
    P = list(partition_by or [])
    O = [F.col(c).asc() for c in order_asc]
    if P and not needs_split(df, P, max_group_rows):
        w = Window.partitionBy(*P).orderBy(*O)
        full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return (df.withColumn(f"prev_{col}", F.lag(col, n).over(w))
                  .withColumn(f"next_{col}", F.lead(col, n).over(w))
                  .withColumn(f"first_{col}", F.first(col).over(full))
                  .withColumn(f"last_{col}", F.last(col).over(full)))
    r = row_index(df, P, O, "_rn", max_group_rows=0, num_chunks=num_chunks)
    r = shifted(r, P, "_rn", [col], n, "prev_")
    r = shifted(r, P, "_rn", [col], -n, "next_")
    key = F.struct(*[F.col(c) for c in order_asc])
    ends = df.groupBy(*P).agg(F.min_by(col, key).alias(f"first_{col}"), F.max_by(col, key).alias(f"last_{col}"))
    if not P:
        vals = ends.first()
        return r.drop("_rn").withColumn(f"first_{col}", F.lit(vals[0])).withColumn(f"last_{col}", F.lit(vals[1]))
    return join_back(r, ends, P).drop("_rn")
