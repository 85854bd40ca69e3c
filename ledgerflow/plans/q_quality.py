"""DQ-1..11 registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cleaning as cl
from ..operators import quality as dq
from ..sources.tables import SCHEMAS, load
from .catalog import register


def _t(spark, sf, name):
    return load(spark, sf, name)


def _row_sql(table, rule, column, fail_sql):
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
            f"CAST(count_if({fail_sql}) AS BIGINT) AS failed, CAST(COUNT(*) AS BIGINT) AS total FROM {table}")


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@register("dq1_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
    f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS min_value, "
    f"CAST(MAX({c}) AS VARCHAR) AS max_value FROM part" for c in PART_COLS))
def dq1_profile(spark, sf):
    return dq.profile(_t(spark, sf, "part"), PART_COLS)


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("dq2_completeness", "\nUNION ALL\n".join(
    _row_sql("customer", "not_null", c, f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''") for c in CUSTOMER_COLS))
def dq2_completeness(spark, sf):
    return dq.evaluate(_t(spark, sf, "customer"), [dq.not_null(c) for c in CUSTOMER_COLS], "customer")


_UNIQ = ("SELECT '{t}' AS table_name, 'unique' AS rule, '{k}' AS column_name, "
         "CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS failed, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total "
         "FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k})")


@register("dq3_uniqueness", _UNIQ.format(t="lineitem", k="l_orderkey,l_linenumber") + "\nUNION ALL\n"
          + _UNIQ.format(t="orders", k="o_orderkey"))
def dq3_uniqueness(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    return dq.unique(li, ["l_orderkey", "l_linenumber"], "lineitem").unionByName(
        dq.unique(o, ["o_orderkey"], "orders"))


_RANGES = [("customer", "c_acctbal", 0, 10000), ("lineitem", "l_discount", 0, 0.1),
           ("lineitem", "l_quantity", 1, 50), ("orders", "o_totalprice", 0, None)]


def _range_sql(t, c, lo, hi):
    parts = [f"{c} < {lo}"] if lo is not None else []
    parts += [f"{c} > {hi}"] if hi is not None else []
    return _row_sql(t, "in_range", c, "COALESCE(" + " OR ".join(parts) + ", FALSE)")


def _edge_sql(t, c, v, side):
    return _row_sql(t, f"at_{side}", c, f"COALESCE({c} = {v}, FALSE)")


@register("dq4_range", "\nUNION ALL\n".join(
    [_range_sql(*r) for r in _RANGES]
    + [_edge_sql(t, c, lo, "min") for t, c, lo, hi in _RANGES if lo is not None]
    + [_edge_sql(t, c, hi, "max") for t, c, lo, hi in _RANGES if hi is not None]))
def dq4_range(spark, sf):
    """Out-of-range counts plus how many rows sit exactly on each bound
    (boundary values are where off-by-one rules break)."""
    out = None
    by_table: dict[str, list] = {}
    for t, c, lo, hi in _RANGES:
        rs = by_table.setdefault(t, [])
        rs.append(dq.in_range(c, lo, hi))
        if lo is not None:
            rs.append(dq.Rule("at_min", c, F.coalesce(F.col(c) == F.lit(lo), F.lit(False))))
        if hi is not None:
            rs.append(dq.Rule("at_max", c, F.coalesce(F.col(c) == F.lit(hi), F.lit(False))))
    for t, rs in by_table.items():
        r = dq.evaluate(_t(spark, sf, t), rs, t)  # one aggregate per table
        out = r if out is None else out.unionByName(r)
    return out


@register("dq5_accepted_pattern", "\nUNION ALL\n".join([
    _row_sql("orders", "accepted_values", "o_orderstatus", "COALESCE(o_orderstatus NOT IN ('F', 'O'), FALSE)"),
    _row_sql("orders", "pattern", "o_orderpriority",
             "COALESCE(NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$'), FALSE)"),
    _row_sql("customer", "pattern", "c_name", "COALESCE(NOT regexp_matches(c_name, '^Customer#[0-9]{9}$'), FALSE)"),
]))
def dq5_accepted_pattern(spark, sf):
    o = dq.evaluate(_t(spark, sf, "orders"), [dq.accepted("o_orderstatus", ["F", "O"]),
                                              dq.matches("o_orderpriority", "^[1-5]-[A-Z ]+$")], "orders")
    c = dq.evaluate(_t(spark, sf, "customer"), [dq.matches("c_name", "^Customer#[0-9]{9}$")], "customer")
    return o.unionByName(c)


_REFS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
         ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
         ("labels", "doc_id", "documents", "doc_id")]


@register("dq6_references", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'references' AS rule, '{fk}' AS column_name, "
    f"CAST(count_if({fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)) AS BIGINT) AS failed, "
    f"CAST(COUNT(*) AS BIGINT) AS total FROM {t}" for t, fk, p, pk in _REFS))
def dq6_references(spark, sf):
    out = None
    for t, fk, p, pk in _REFS:
        r = dq.references(_t(spark, sf, t), fk, _t(spark, sf, p), pk, t)
        out = r if out is None else out.unionByName(r)
    return out


_DQ7_SQL = """
SELECT 'lineitem' AS table_name, 'ship_after_order' AS rule, 'l_shipdate' AS column_name,
       CAST(count_if(NOT COALESCE(CAST(l.l_shipdate AS DATE) >= CAST(o.o_orderdate AS DATE), TRUE)) AS BIGINT) AS failed,
       CAST(COUNT(*) AS BIGINT) AS total
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


@register("dq7_cross_column", _DQ7_SQL)
def dq7_cross_column(spark, sf):
    """Rule across two tables: bring the order date to the line (one
    shuffle join), then one aggregate."""
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    j = li.select("l_orderkey", "l_shipdate").join(
        o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left")
    return dq.evaluate(j, [dq.check("ship_after_order", F.to_date("l_shipdate") >= F.to_date("o_orderdate"),
                                    "l_shipdate")], "lineitem")


_GATE_LIMITS = {"not_null": 0.0, "in_range": 0.1, "unique": 0.0, "references": 0.0, "ship_after_order": 0.6}


def _gate_inputs(spark, sf):
    return (dq2_completeness(spark, sf).unionByName(dq3_uniqueness(spark, sf))
            .unionByName(dq6_references(spark, sf)).unionByName(dq7_cross_column(spark, sf))
            .unionByName(dq.evaluate(_t(spark, sf, "customer"), [dq.in_range("c_acctbal", 0, 10000)], "customer")))


def _gate_sql():
    parts = [ORACLE_REF[k] for k in ("dq2_completeness", "dq3_uniqueness", "dq6_references", "dq7_cross_column")]
    parts.append(_range_sql("customer", "c_acctbal", 0, 10000))
    lim = "CASE " + " ".join(f"WHEN rule = '{k}' THEN {v}" for k, v in _GATE_LIMITS.items()) + " ELSE 0.0 END"
    return f"""
WITH r AS ({" UNION ALL ".join(f"({p})" for p in parts)}),
g AS (SELECT *, CASE WHEN total > 0 THEN CAST(failed AS DOUBLE) / total ELSE 0.0 END AS failed_fraction FROM r),
h AS (SELECT *, failed_fraction <= {lim} AS passed FROM g)
SELECT *, CASE WHEN bool_and(passed) OVER () THEN 'pass' ELSE 'block' END AS decision FROM h
"""


from .catalog import ORACLE as ORACLE_REF  # noqa: E402


@register("dq8_gate", _gate_sql())
def dq8_gate(spark, sf):
    return dq.gate(_gate_inputs(spark, sf), _GATE_LIMITS)


_DQ10_SQL = """
WITH daily AS (
  SELECT CAST(ts AS DATE) AS day, round(CAST(count_if(event_type = 'error') AS DOUBLE) / COUNT(*), 6) AS error_rate
  FROM events GROUP BY 1),
t AS (
  SELECT a.day, round(avg(b.error_rate), 6) AS trailing_mean, COUNT(b.day) AS trailing_days
  FROM daily a LEFT JOIN daily b ON b.day >= a.day - INTERVAL 7 DAY AND b.day < a.day GROUP BY a.day)
SELECT d.day, d.error_rate, t.trailing_mean, CAST(t.trailing_days AS BIGINT) AS trailing_days,
       COALESCE(d.error_rate > t.trailing_mean * 1.5, FALSE) AS alert
FROM daily d JOIN t ON d.day = t.day
"""


@register("dq10_trend", _DQ10_SQL)
def dq10_trend(spark, sf):
    e = _t(spark, sf, "events")
    daily = e.groupBy(F.to_date("ts").alias("day")).agg(
        F.round(F.count_if(F.col("event_type") == "error") / F.count(F.lit(1)), 6).alias("error_rate"))
    r = dq.dq_trend(daily, "day", "error_rate", lookback=7, factor=1.5)
    return r.select("day", "error_rate", F.round("trailing_mean", 6).alias("trailing_mean"),
                    F.coalesce("trailing_days", F.lit(0)).cast("bigint").alias("trailing_days"),
                    (F.coalesce(F.col("error_rate") > F.round("trailing_mean", 6) * 1.5, F.lit(False))).alias("alert"))


_DQ10_RULES = [("in_range", "value", "value < 0 OR value > 150"), ("accepted_values", "event_type", "event_type NOT IN ('view', 'click', 'purchase', 'signup')"),
               ("no_error_value", "*", "event_type = 'error' AND value > 60")]


def _dq10_rules_sql():
    per = " UNION ALL ".join(
        f"SELECT CAST(ts AS DATE) AS day, '{r}' AS rule, '{c}' AS column_name, CAST(count_if(coalesce({f}, FALSE)) AS BIGINT) AS failed, "
        f"CAST(COUNT(*) AS BIGINT) AS total FROM events GROUP BY 1" for r, c, f in _DQ10_RULES)
    return f"""
WITH r AS (SELECT *, CAST(failed AS DOUBLE) / total AS failed_rate FROM ({per})),
t AS (SELECT a.day, a.rule, a.column_name, round(avg(b.failed_rate), 6) AS trailing_mean
      FROM r a LEFT JOIN r b ON b.rule = a.rule AND b.column_name = a.column_name AND b.day >= a.day - INTERVAL 7 DAY AND b.day < a.day GROUP BY ALL)
SELECT r.day, r.rule, r.column_name, r.failed, r.total, t.trailing_mean,
       coalesce(round(r.failed_rate, 6) > t.trailing_mean * 1.5, FALSE) AS alert
FROM r JOIN t USING (day, rule, column_name)
"""


@register("dq10_rule_trend", _dq10_rules_sql())
def dq10_rule_trend(spark, sf):
    """Rule results followed over days: every rule is a series of its own."""
    rules = [dq.in_range("value", 0, 150), dq.accepted("event_type", ["view", "click", "purchase", "signup"]),
             dq.check("no_error_value", ~((F.col("event_type") == "error") & (F.col("value") > 60)))]
    daily = dq.evaluate_by(_t(spark, sf, "events"), F.to_date("ts"), rules)
    r = dq.dq_trend(daily, "batch", "failed_rate", by=["rule", "column_name"])
    mean = F.round("trailing_mean", 6)
    return r.select(F.col("batch").alias("day"), "rule", "column_name", "failed", "total", mean.alias("trailing_mean"),
                    F.coalesce(F.round("failed_rate", 6) > mean * 1.5, F.lit(False)).alias("alert"))


@register("dq10_drift", """
WITH c AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS batch, 'event_type' AS column_name, event_type AS bucket, COUNT(*) AS n FROM events GROUP BY 1, 3
  UNION ALL
  SELECT CAST(date_trunc('week', ts) AS DATE), 'value', CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR), COUNT(*) FROM events GROUP BY 1, 3),
t AS (SELECT batch, column_name, SUM(n) AS n_rows, lag(SUM(n)) OVER w AS n_before, lag(batch) OVER w AS prior
      FROM c GROUP BY batch, column_name WINDOW w AS (PARTITION BY column_name ORDER BY batch)),
b AS (SELECT t.batch, t.column_name, k.bucket FROM t JOIN c k ON k.column_name = t.column_name AND k.batch IN (t.batch, t.prior) GROUP BY ALL),
g AS (
  SELECT t.batch, t.column_name, t.n_rows, t.n_before, SUM(abs(coalesce(x.n, 0) * t.n_before - coalesce(y.n, 0) * t.n_rows)) AS gap
  FROM t JOIN b ON b.batch = t.batch AND b.column_name = t.column_name
  LEFT JOIN c x ON x.batch = t.batch AND x.column_name = b.column_name AND x.bucket = b.bucket
  LEFT JOIN c y ON y.batch = t.prior AND y.column_name = b.column_name AND y.bucket = b.bucket GROUP BY ALL)
SELECT batch, column_name, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_before AS BIGINT) AS n_before,
       CAST(gap AS DOUBLE) / CAST(2 * n_rows * n_before AS DOUBLE) AS distance,
       coalesce(CAST(gap AS DOUBLE) / CAST(2 * n_rows * n_before AS DOUBLE) > 0.05, FALSE) AS alert
FROM g
""")
def dq10_drift(spark, sf):
    """Distribution of event types and values, each week against the one before."""
    e = _t(spark, sf, "events")
    return dq.drift(e, F.date_trunc("week", "ts").cast("date"), {"event_type": F.col("event_type"), "value": F.floor(F.col("value") / 20).cast("bigint")}, 0.05)


_FEED_LIMITS = {"in_range": 0.05, "not_null": 0.0, "pattern": 0.0}


@register("flow_gated_load", """
SELECT 'customer' AS feed, 'block' AS decision, CAST(0 AS BIGINT) AS in_target, CAST(0 AS BIGINT) AS in_dead_letter
UNION ALL
SELECT 'orders', 'pass', CAST(count_if(o_totalprice >= 2000) AS BIGINT), CAST(count_if(o_totalprice < 2000) AS BIGINT) FROM orders
""")
def flow_gated_load(spark, sf):
    """Rules, gate, write, end to end: a feed is written (clean rows and dead
    letters) only if the gate passes. Customers are blocked by their negative
    balances (8 %, 5 % allowed), so nothing of theirs is stored."""
    from ..session import scratch_path
    from ..sinks.writes import gated_write
    base = scratch_path(spark, "gated")
    feeds = {"customer": [dq.not_null("c_custkey"), dq.in_range("c_acctbal", 0)],
             "orders": [dq.not_null("o_orderkey"), dq.in_range("o_totalprice", 2000), dq.matches("o_orderpriority", "^[1-5]-[A-Z ]+$")]}
    out = []
    for feed, rules in feeds.items():
        done = gated_write(spark, feed, "b1", _t(spark, sf, feed), rules, _FEED_LIMITS, f"{base}/{feed}", f"{base}/audit")
        out.append((feed, done["decision"], done["rows_out"], done["rows_rejected"]))
    return spark.createDataFrame(out, "feed string, decision string, in_target bigint, in_dead_letter bigint")


# Contract the orders feed is expected to meet: o_orderdate as a DATE and an
# o_clerk column; the fixture stores a timestamp and has no clerk.
# Contract for orders as a downstream consumer declares it: keys NOT NULL,
# order date a DATE, a clerk column, and no priority column.
_NOT_NULL = ("o_orderkey", "o_custkey")
ORDERS_CONTRACT = T.StructType(
    [T.StructField(f.name, T.DateType() if f.name == "o_orderdate" else f.dataType, f.name not in _NOT_NULL)
     for f in SCHEMAS["orders"].fields if f.name != "o_orderpriority"]
    + [T.StructField("o_clerk", T.StringType(), True)])

_DQ11_SQL = """
WITH actual AS (
  SELECT column_name AS c, "null" AS nullable,
         CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                          WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
                          ELSE lower(column_type) END AS t
  FROM (DESCRIBE orders)),
expected AS (SELECT * FROM (VALUES ('o_orderkey', 'bigint', false), ('o_custkey', 'bigint', false),
                                   ('o_orderstatus', 'string', true), ('o_totalprice', 'double', true),
                                   ('o_orderdate', 'date', true), ('o_clerk', 'string', true)) v(c, t, nullable)),
n AS (SELECT COUNT(*) AS n_all, COUNT(o_orderpriority) AS n_priority,
             count_if(o_orderkey IS NULL) AS n_null_orderkey, count_if(o_custkey IS NULL) AS n_null_custkey,
             count_if(o_orderdate IS NOT NULL AND (TRY_CAST(o_orderdate AS DATE) IS NULL
                      OR CAST(TRY_CAST(o_orderdate AS DATE) AS TIMESTAMP) <> o_orderdate)) AS n_bad_date
      FROM orders),
f AS (
  SELECT e.c AS column_name, 'missing' AS problem, e.t AS expected, '' AS actual
  FROM expected e LEFT JOIN actual a ON a.c = e.c WHERE a.c IS NULL
  UNION ALL
  SELECT e.c, 'type', e.t, a.t FROM expected e JOIN actual a ON a.c = e.c WHERE a.t <> e.t
  UNION ALL
  SELECT e.c, 'nullable', 'not null', 'nullable' FROM expected e JOIN actual a ON a.c = e.c
  WHERE NOT e.nullable AND a.nullable = 'YES'
  UNION ALL
  SELECT a.c, 'unexpected', '', a.t FROM actual a LEFT JOIN expected e ON a.c = e.c WHERE e.c IS NULL)
SELECT f.*, CAST(CASE WHEN problem = 'missing' THEN n_all
                      WHEN problem = 'unexpected' AND column_name = 'o_orderpriority' THEN n_priority
                      WHEN problem = 'nullable' AND column_name = 'o_orderkey' THEN n_null_orderkey
                      WHEN problem = 'nullable' AND column_name = 'o_custkey' THEN n_null_custkey
                      WHEN problem = 'type' AND column_name = 'o_orderdate' THEN n_bad_date END AS BIGINT) AS violating_rows
FROM f, n
"""


@register("dq11_contract", _DQ11_SQL)
def dq11_contract(spark, sf):
    o = spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet")  # as stored, not as declared
    return dq.check_contract(o, ORDERS_CONTRACT)


def _dq9_sql():
    from .q_io import _ANY_BAD_SQL, _FAILED_SQL
    return f"SELECT event_id, user_id, value, {_FAILED_SQL} AS failed_rules, 'b1' AS batch_id FROM events WHERE {_ANY_BAD_SQL}"


@register("dq9_quarantine", _dq9_sql())
def dq9_quarantine(spark, sf):
    """Failing rows moved to a quarantine table with the rules they broke
    (the dead-letter half of SNK-3), read back from where they were written."""
    from ..session import scratch_path
    from ..sinks.writes import split_dead_letter
    from .q_io import event_rules
    _, bad = split_dead_letter(_t(spark, sf, "events"), event_rules(), "b1")  # only this side is stored
    path = scratch_path(spark, "dq9-quarantine")
    bad.write.parquet(path)
    q = spark.read.parquet(path)
    return q.select("event_id", "user_id", "value", F.concat_ws(";", "failed_rules").alias("failed_rules"),
                    "batch_id")


_SEGMENTS = {"AUTOMOBILE": "Vehicles", "machinery": "Vehicles", "Building": "Home", "FURNITURE": "Home"}


@register("cl1_clean", """
WITH c AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS bal FROM customer),
m AS (SELECT c_nationkey, round(CAST(SUM(bal) AS DOUBLE) / COUNT(bal), 2) AS mean FROM c GROUP BY 1)
SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Vehicles'
                       WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Home' ELSE 'Other' END AS c_mktsegment,
       coalesce(CAST(bal AS DOUBLE), mean) AS balance, bal IS NULL AND mean IS NOT NULL AS was_filled
FROM c JOIN m USING (c_nationkey)
""")
def cl1_clean(spark, sf):
    """Debts count as missing and take the nation's mean balance; segments
    take standard names."""
    c = _t(spark, sf, "customer")
    c = c.withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)")).cast("double"))
    c = cl.standardise(c, "c_mktsegment", _SEGMENTS, "Other")
    mean = F.round(F.sum(F.col("balance").cast("decimal(18,2)")).cast("double") / F.count("balance"), 2)
    c = cl.fill_by_group(c, "balance", ["c_nationkey"], mean, "was_filled")
    return c.select("c_custkey", "c_mktsegment", "balance", "was_filled")
