"""Data quality (DQ-1..11).

Row rules over one table are evaluated in **one** aggregate (one scan, one
tiny shuffle of partial counts). Key rules (uniqueness, references) need
their own shuffle each. Results are long-format frames with one row per
rule: ``(rule, column, failed, total)``; the gate is a driver decision over
that small frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import keep
from ..sources.tables import contract_violations


@dataclass(frozen=True)
class Rule:
    """A row rule: ``fails`` is TRUE for a failing row (NULL counts as pass)."""
    name: str
    column: str
    fails: Column


# --- rule builders (DQ-2, 4, 5, 7) -------------------------------------------
def not_null(col: str, blank_is_null: bool = True) -> Rule:
    c = F.col(col)
    f = c.isNull()
    if blank_is_null:
        f = f | (F.trim(c.cast("string")) == "")
    return Rule("not_null", col, f)


def in_range(col: str, lo=None, hi=None) -> Rule:
    c = F.col(col)
    f = F.lit(False)
    if lo is not None:
        f = f | (c < F.lit(lo))
    if hi is not None:
        f = f | (c > F.lit(hi))
    return Rule("in_range", col, F.coalesce(f, F.lit(False)))


def accepted(col: str, values: Sequence) -> Rule:
    return Rule("accepted_values", col, F.coalesce(~F.col(col).isin(list(values)), F.lit(False)))


def matches(col: str, pattern: str) -> Rule:
    return Rule("pattern", col, F.coalesce(~F.col(col).rlike(pattern), F.lit(False)))


def check(name: str, expr: Column, column: str = "*") -> Rule:
    """Cross-column rule; the row fails only when ``expr`` is FALSE."""
    return Rule(name, column, ~F.coalesce(expr, F.lit(True)))


def evaluate(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """All row rules of one table in one aggregate -> (table, rule, column, failed, total)."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(r.fails).alias(f"_r{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"),
                 F.col(f"_r{i}").cast("bigint").alias("failed"))
        for i, r in enumerate(rules)])).alias("_x")
    return one.select(F.col("_total").cast("bigint").alias("total"), rows).select(
        F.lit(table).alias("table_name"), "_x.rule", "_x.column_name", "_x.failed", "total")


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Array of ``rule:column`` names failed by the row (empty = clean)."""
    tags = [F.when(r.fails, F.lit(f"{r.name}:{r.column}")) for r in rules]
    return F.filter(F.array(*tags), lambda x: x.isNotNull())


# --- DQ-1 --------------------------------------------------------------------
def profile(df: DataFrame, cols: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct, min, max (as strings).

    Each column is counted per value first, one pruned scan and one shuffle
    of its distinct values (a hot value is one row per task), and everything
    follows from these counts; several exact distinct counts in one aggregate
    would copy every row once per column. ``exact_distinct=False`` takes one
    aggregate for all columns with HyperLogLog sketches, which combine
    map-side in fixed memory; use it on wide or very large tables.
    """
    cols = list(cols or df.columns)
    out = None
    if exact_distinct:
        for c in cols:
            per_value = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
            one = per_value.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
                                F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("n_null"),
                                F.count("_v").cast("bigint").alias("n_distinct"),
                                F.min("_v").cast("string").alias("min_value"), F.max("_v").cast("string").alias("max_value"))
            one = one.select(F.lit(c).alias("column_name"), "n_rows", "n_null", "n_distinct", "min_value", "max_value")
            out = one if out is None else out.unionByName(one)
        return out
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}"), F.approx_count_distinct(F.col(c)).alias(f"_d{i}"),
                 F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("bigint").alias("n_null"),
                 F.col(f"_d{i}").cast("bigint").alias("n_distinct"),
                 F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"))
        for i, c in enumerate(cols)])).alias("_x")
    return one.select(F.col("_rows").cast("bigint").alias("n_rows"), rows).select(
        "_x.column_name", "n_rows", "_x.n_null", "_x.n_distinct", "_x.min_value", "_x.max_value")


# --- DQ-3 --------------------------------------------------------------------
def unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Uniqueness as a rule result: failed = rows beyond the first per key."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("failed"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("column_name"),
        "failed", "total")


# --- DQ-6 --------------------------------------------------------------------
def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (anti join)."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def references(child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str) -> DataFrame:
    """Referential integrity as a rule result; a NULL FK is exempt.

    One scan of the child: rows are counted per key before they move (a hot
    key is one row per task), and the counts of keys without a parent and of
    all keys are summed together."""
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    j = per_key.join(keys, per_key["_fk"] == keys["_pk"], "left")
    orphan = F.col("_fk").isNotNull() & F.col("_pk").isNull()
    return j.agg(F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("failed"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total")).select(
        F.lit(table).alias("table_name"), F.lit("references").alias("rule"), F.lit(fk).alias("column_name"), "failed", "total")


# --- DQ-8 --------------------------------------------------------------------
def gate(results: DataFrame, max_failed_fraction: dict[str, float] | float = 0.0) -> DataFrame:
    """Rule results + thresholds -> per-rule ``passed`` and an overall
    ``decision`` ('pass' | 'block') on every row. Thresholds are keyed by
    ``rule`` or ``rule:column``; a float applies to every rule."""
    if isinstance(max_failed_fraction, dict):
        lim = F.lit(0.0)
        expr = None
        for k, v in max_failed_fraction.items():
            cond = (F.concat_ws(":", "rule", "column_name") == k) | (F.col("rule") == k)
            expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
        lim = expr.otherwise(F.lit(0.0)) if expr is not None else lim
    else:
        lim = F.lit(float(max_failed_fraction))
    frac = F.when(F.col("total") > 0, F.col("failed") / F.col("total")).otherwise(F.lit(0.0))
    # One row per rule: cache it so the decision and the output share one run
    # of the rule jobs.
    r = results.withColumn("failed_fraction", frac).withColumn("passed", frac <= lim).cache()
    # The overall decision needs every rule. The results frame has one row
    # per rule, so this is one scalar from a tiny aggregate.
    ok = r.agg(F.min(F.col("passed").cast("int"))).first()[0]
    return r.withColumn("decision", F.lit("pass" if ok in (None, 1) else "block"))


def gate_passes(gated: DataFrame) -> bool:
    """Driver decision between two jobs: the frame has one row per rule."""
    return all(r["passed"] for r in gated.select("passed").collect())


# --- DQ-10 -------------------------------------------------------------------
def evaluate_by(df: DataFrame, by: Column, rules: Sequence[Rule]) -> DataFrame:
    """Row rules per batch (``by``, such as the load day): (batch, rule,
    column_name, failed, total, failed_rate), all rules in one aggregate."""
    aggs = [F.count_if(r.fails).alias(f"_r{i}") for i, r in enumerate(rules)]
    g = df.groupBy(by.alias("batch")).agg(F.count(F.lit(1)).cast("bigint").alias("total"), *aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"), F.col(f"_r{i}").cast("bigint").alias("failed"))
        for i, r in enumerate(rules)])).alias("_x")
    return g.select("batch", "total", rows).select("batch", "_x.rule", "_x.column_name", "_x.failed", "total",
                                                   (F.col("_x.failed") / F.col("total")).alias("failed_rate"))


def dq_trend(daily: DataFrame, day: str, rate: str, lookback: int = 7, factor: float = 1.5,
             by: Sequence[str] = ()) -> DataFrame:
    """Alert when a day's rate exceeds ``factor`` x the mean of the previous
    ``lookback`` days (of the same series, where ``by`` tells series apart,
    such as a rule's name and column). The trailing mean is an equi-join on
    ``day - i`` for i in 1..lookback (bounded fan-out), not an unpartitioned
    window."""
    by = list(by)
    back = daily.select(*by, F.col(day).alias("_d"), F.col(rate).alias("_r")).withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.lit(lookback)))).select(
        *by, F.date_add("_d", F.col("_i")).alias(day), "_r")
    trail = back.groupBy(*by, day).agg(F.avg("_r").alias("trailing_mean"), F.count(F.lit(1)).alias("trailing_days"))
    j = daily.join(trail, [*by, day], "left")
    return j.withColumn("alert", F.coalesce(F.col(rate) > F.col("trailing_mean") * factor, F.lit(False)))


def drift(df: DataFrame, batch: Column, buckets: dict[str, Column], limit: float = 0.1) -> DataFrame:
    """(batch, column_name, n_rows, n_before, distance, alert): how far the
    distribution of each bucketed column lies from that of the batch before,
    as total variation (0 equal, 1 disjoint), an exact ratio of counts. The
    first batch has no distance. Rows are counted per batch, column and bucket
    in every task before they move; a NULL bucket is one of its own."""
    cols = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), c.cast("string").alias("bucket")) for n, c in buckets.items()]))
    per = df.select(batch.alias("batch"), cols.alias("_x")).groupBy("batch", "_x.column_name", "_x.bucket").agg(F.count(F.lit(1)).alias("n"))
    per = keep(per, "dq10-counts")
    total = per.groupBy("batch", "column_name").agg(F.sum("n").alias("n_rows"))
    # A row per batch and column: few, whatever the data.
    order = Window.partitionBy("column_name").orderBy("batch")
    total = total.withColumn("n_before", F.lag("n_rows").over(order)).withColumn("next", F.lead("batch").over(order))
    after = per.join(total.select("batch", "column_name", "next"), ["batch", "column_name"]).filter("next is not null")
    zero = F.lit(0).cast("bigint")
    both = per.select("batch", "column_name", "bucket", F.col("n").alias("here"), zero.alias("before")).unionByName(
        after.select(F.col("next").alias("batch"), "column_name", "bucket", zero.alias("here"), F.col("n").alias("before")))
    both = both.groupBy("batch", "column_name", "bucket").agg(F.sum("here").alias("here"), F.sum("before").alias("before"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    apart = both.join(total.drop("next"), ["batch", "column_name"]).groupBy("batch", "column_name").agg(
        F.max("n_rows").alias("n_rows"), F.max("n_before").alias("n_before"), F.sum(F.abs(wide("here") * wide("n_before") - wide("before") * wide("n_rows"))).alias("gap"))
    distance = F.col("gap").cast("double") / (2 * wide("n_rows") * wide("n_before")).cast("double")
    return apart.select("batch", "column_name", "n_rows", "n_before", distance.alias("distance"), F.coalesce(distance > limit, F.lit(False)).alias("alert"))


# --- DQ-11 -------------------------------------------------------------------
def _violating(df: DataFrame, name: str, problem: str, expected: T.StructType) -> Column:
    """Rows a schema finding affects, as one aggregate expression."""
    if problem == "missing":
        return F.count(F.lit(1))
    c = F.col(name)
    if problem == "unexpected":
        return F.count(c)
    if problem == "nullable":
        return F.count_if(c.isNull())
    # type: a non-NULL value that does not convert, or converts lossily
    # (does not come back equal when cast back).
    want = expected[name].dataType
    conv = c.try_cast(want)
    return F.count_if(c.isNotNull() & (conv.isNull() | (conv.cast(df.schema[name].dataType) != c)))


def check_contract(df: DataFrame, expected: T.StructType, count_rows: bool = True) -> DataFrame:
    """(column_name, problem, expected, actual, violating_rows) for every
    difference between ``df`` and the contract.

    Problems: missing, unexpected, type, nullable (declared NOT NULL, stored
    nullable). ``violating_rows`` counts the rows each finding affects:
    all rows for a missing column, non-NULL values of an unexpected one,
    values that do not round-trip through the declared type, NULLs in a NOT
    NULL column. The counts of all findings come from one aggregate (one
    scan, reading only the columns with findings).
    ``count_rows=False`` compares schemas only (counts NULL)."""
    bad = contract_violations(df.schema, expected)
    spark = df.sparkSession
    schema = "column_name string, problem string, expected string, actual string, violating_rows bigint"
    if not bad or not count_rows:
        return spark.createDataFrame([(*b, None) for b in bad], schema)
    one = df.agg(*[_violating(df, b[0], b[1], expected).alias(f"_v{i}") for i, b in enumerate(bad)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(b[0]).alias("column_name"), F.lit(b[1]).alias("problem"), F.lit(b[2]).alias("expected"),
                 F.lit(b[3]).alias("actual"), F.col(f"_v{i}").cast("bigint").alias("violating_rows"))
        for i, b in enumerate(bad)])).alias("_x")
    return one.select(rows).select("_x.*")
