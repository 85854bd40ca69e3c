"""Relational core: PRJ, JN, AG, SQ, WN, SL, RC, SC registered queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import aggregates as ag
from ..operators import joins as jn
from ..operators import windows as wn
from ..sources.tables import load, register_views
from .catalog import register

REV = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


def _t(spark, sf, name):
    return load(spark, sf, name)


# --- PRJ ---------------------------------------------------------------------
@register("prj1_select", f"""
SELECT l_orderkey, l_linenumber, upper(l_returnflag) || l_linestatus AS flag_status,
       CAST({REV} AS DOUBLE) AS revenue, CAST(l_shipdate AS DATE) AS ship_day
FROM lineitem
""")
def prj1_select(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.concat(F.upper("l_returnflag"), F.col("l_linestatus")).alias("flag_status"),
                     sc.as_double(sc.revenue()).alias("revenue"), F.to_date("l_shipdate").alias("ship_day"))


@register("prj2_filter", """
SELECT l_orderkey, l_linenumber, l_discount, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_discount > 0.05 AND l_returnflag = 'R'
""")
def prj2_filter(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.filter((F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
                     & (F.col("l_discount") > 0.05) & (F.col("l_returnflag") == "R")) \
             .select("l_orderkey", "l_linenumber", "l_discount", "l_shipdate")


@register("prj3_safe_div", """
SELECT o_custkey, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_finished,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count_if(o_orderstatus = 'F'), 0)
         AS spend_per_finished
FROM orders GROUP BY o_custkey
""")
def prj3_safe_div(spark, sf):
    o = _t(spark, sf, "orders")
    g = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").cast("bigint").alias("n_finished"),
                                   sc.as_double(F.sum(sc.money("o_totalprice"))).alias("_spend"))
    return g.select("o_custkey", "n_finished",
                    sc.safe_div(F.col("_spend"), F.col("n_finished")).alias("spend_per_finished"))


@register("prj4_get_or", """
SELECT event_id, CAST(COALESCE(json_extract_string(props, '$.k'), '-1') AS BIGINT) AS k,
       CAST(COALESCE(json_extract_string(props, '$.missing'), '0') AS BIGINT) AS missing
FROM events
""")
def prj4_get_or(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", sc.get_or("props", "k", "-1").cast("bigint").alias("k"),
                    sc.get_or("props", "missing", "0").cast("bigint").alias("missing"))


@register("prj5_parse_typed", """
SELECT p_partkey,
       TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
       CASE WHEN split_part(p_brand, '#', 2) IS NOT NULL AND TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) IS NULL
            THEN 'not a int: ' || split_part(p_brand, '#', 2) END AS brand_no_reason,
       TRY_CAST(p_type AS INTEGER) AS type_no,
       CASE WHEN p_type IS NOT NULL AND TRY_CAST(p_type AS INTEGER) IS NULL THEN 'not a int: ' || p_type END AS type_no_reason
FROM part
""")
def prj5_parse_typed(spark, sf):
    p = _t(spark, sf, "part")
    bv, br = sc.parse_typed(F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)), "int")
    tv, tr = sc.parse_typed(F.col("p_type"), "int")
    return p.select("p_partkey", bv.alias("brand_no"), br.alias("brand_no_reason"),
                    tv.alias("type_no"), tr.alias("type_no_reason"))


# --- JN ----------------------------------------------------------------------
@register("jn1_inner", f"""
SELECT p.p_brand, COUNT(*) AS n_lines, CAST(SUM({REV}) AS DOUBLE) AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand
""")
def jn1_inner(spark, sf):
    li, p = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    # Aggregate lines to part grain first: the join then moves one row per part.
    per_part = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("_n"), F.sum(sc.revenue()).alias("_r"))
    j = per_part.join(p.select("p_partkey", "p_brand"), per_part.l_partkey == p.p_partkey)
    return j.groupBy("p_brand").agg(F.sum("_n").cast("bigint").alias("n_lines"),
                                    sc.as_double(F.sum("_r")).alias("revenue"))


@register("jn2_left", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def jn2_left(spark, sf):
    d, lb = _t(spark, sf, "documents"), _t(spark, sf, "labels")
    return d.select("doc_id", "lang").join(lb, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@register("jn3_anti", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def jn3_anti(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    return o.select("o_orderkey", "o_custkey").join(
        li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


_JN3_NOT_IN = """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
"""


@register("jn3_not_in", _JN3_NOT_IN)
def jn3_not_in(spark, sf):
    """The NOT IN form with its NULL rules (a NULL in the subquery empties
    the result; a NULL key qualifies only against an empty subquery). Spark's
    own plan broadcasts the whole subquery, however large; this one is a
    shuffled anti join on the distinct keys and one scalar."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    return jn.not_in(o.select("o_orderkey", "o_custkey"), "o_orderkey", li, "l_orderkey")


@register("jn4_semi", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def jn4_semi(spark, sf):
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return c.select("c_custkey", "c_name").join(urgent, "c_custkey", "left_semi")


@register("jn5_self_inequality", """
WITH s AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate,
         lag(o_orderkey) OVER w AS prev_orderkey, lag(o_totalprice) OVER w AS prev_totalprice,
         lag(o_orderdate) OVER w AS prev_orderdate
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, prev_orderkey, o_totalprice - prev_totalprice AS increase,
       CAST(date_diff('day', prev_orderdate, o_orderdate) AS INTEGER) AS gap_days
FROM s WHERE prev_orderkey IS NOT NULL AND o_totalprice > prev_totalprice
""")
def jn5_self_inequality(spark, sf):
    """Orders whose total rose over the same customer's previous order: an
    equi self join on (customer, position) with an inequality residual."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    seq = wn.row_index(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq")
    pairs = jn.successive_pairs(seq, ["o_custkey"], "seq",
                                residual=F.col("cur.o_totalprice") > F.col("prev.o_totalprice"))
    return pairs.select(F.col("cur.o_custkey").alias("o_custkey"), F.col("cur.o_orderkey").alias("o_orderkey"),
                        F.col("prev.o_orderkey").alias("prev_orderkey"),
                        (F.col("cur.o_totalprice") - F.col("prev.o_totalprice")).alias("increase"),
                        F.datediff(F.to_date("cur.o_orderdate"), F.to_date("prev.o_orderdate")).cast("int")
                        .alias("gap_days"))


@register("jn6_grain_check", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def jn6_grain_check(spark, sf):
    return jn.check_grain(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_FANOUT_SQL = """
WITH a AS (SELECT {k} AS k, COUNT(*) AS nl FROM {l} GROUP BY 1),
     b AS (SELECT {k2} AS k, COUNT(*) AS nr FROM {r} GROUP BY 1),
     j AS (SELECT a.nl, b.nr FROM a FULL OUTER JOIN b ON a.k = b.k),
     s AS (SELECT CAST(COALESCE(SUM(nl), 0) AS BIGINT) AS left_rows, CAST(COALESCE(SUM(nr), 0) AS BIGINT) AS right_rows,
           CAST(COALESCE(SUM(nl * nr), 0) AS BIGINT) AS joined_rows,
           CAST(COALESCE(MAX(CASE WHEN nr IS NOT NULL THEN nl END), 0) AS BIGINT) AS max_left_per_key,
           CAST(COALESCE(MAX(CASE WHEN nl IS NOT NULL THEN nr END), 0) AS BIGINT) AS max_right_per_key FROM j)
SELECT *, CASE WHEN joined_rows = 0 THEN 'empty'
               WHEN max_left_per_key <= 1 AND max_right_per_key <= 1 THEN '1:1'
               WHEN max_left_per_key <= 1 THEN '1:N' WHEN max_right_per_key <= 1 THEN 'N:1' ELSE 'N:M' END AS relation
FROM s
"""


@register("jn7_fanout", _FANOUT_SQL.format(k="o_orderkey", l="orders", k2="l_orderkey", r="lineitem"))
def jn7_fanout(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey")
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return jn.fanout(o, li, "o_orderkey")


@register("jn7_fanout_nm", _FANOUT_SQL.format(k="(l_orderkey, l_linenumber)", l="lineitem",
                                              k2="(l_orderkey, l_linenumber)", r="lineitem"))
def jn7_fanout_nm(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return jn.fanout(li, li, ["l_orderkey", "l_linenumber"])


@register("jn8_safe_join", f"""
SELECT o.o_orderkey, o.o_totalprice, CAST(COALESCE(x.n_lines, 0) AS BIGINT) AS n_lines, x.revenue
FROM orders o LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n_lines, CAST(SUM({REV}) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1
) x ON o.o_orderkey = x.l_orderkey
""")
def jn8_safe_join(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    j = jn.safe_join(o.select("o_orderkey", "o_totalprice"),
                     li.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey",
                     [F.count(F.lit(1)).alias("_n"), sc.as_double(F.sum(sc.revenue())).alias("revenue")])
    return j.select("o_orderkey", "o_totalprice", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_lines"),
                    "revenue")


# --- AG ----------------------------------------------------------------------
@register("ag1_group_by", f"""
SELECT l_returnflag, l_linestatus,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(SUM({REV}) AS DOUBLE) AS sum_revenue,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_price,
       MIN(l_discount) AS min_disc, MAX(l_discount) AS max_disc, COUNT(*) AS count_order
FROM lineitem GROUP BY 1, 2
""")
def ag1_group_by(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        sc.as_double(F.sum(sc.money("l_quantity"))).alias("sum_qty"),
        sc.as_double(F.sum(sc.revenue())).alias("sum_revenue"),
        (sc.as_double(F.sum(sc.money("l_extendedprice"))) / F.count(F.lit(1))).alias("avg_price"),
        F.min("l_discount").alias("min_disc"), F.max("l_discount").alias("max_disc"),
        F.count(F.lit(1)).alias("count_order"))


@register("ag2_having", """
SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1 HAVING COUNT(*) > 12
""")
def ag2_having(spark, sf):
    o = _t(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")).filter(F.col("n_orders") > 12)


@register("ag3_count_distinct", """
SELECT c.c_nationkey, COUNT(DISTINCT o.o_custkey) AS customers, COUNT(DISTINCT o.o_orderpriority) AS priorities,
       COUNT(*) AS orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1
""")
def ag3_count_distinct(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    j = o.select("o_custkey", "o_orderpriority").join(c.select("c_custkey", "c_nationkey"),
                                                      F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_nationkey").agg(F.countDistinct("o_custkey").alias("customers"),
                                        F.countDistinct("o_orderpriority").alias("priorities"),
                                        F.count(F.lit(1)).alias("orders"))


@register("ag4_conditional", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_finished,
       CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS DOUBLE)
         AS urgent_value,
       CAST(AVG(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) * 100 AS DECIMAL(9,4)) AS pct_open
FROM orders GROUP BY 1
""")
def ag4_conditional(spark, sf):
    o = _t(spark, sf, "orders")
    return o.groupBy(sc.month_start("o_orderdate").alias("month")).agg(
        F.count_if(F.col("o_orderstatus") == "F").cast("bigint").alias("n_finished"),
        sc.as_double(F.coalesce(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", sc.money("o_totalprice"))),
                                F.lit(0))).alias("urgent_value"),
        (F.count_if(F.col("o_orderstatus") == "O") * 100 / F.count(F.lit(1))).cast("decimal(9,4)").alias("pct_open"))


_AG5_SELECT = """
SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS level,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, COUNT(*) AS n
FROM lineitem GROUP BY {g}
"""


def _ag5(spark, sf, mode, sets=None):
    li = _t(spark, sf, "lineitem")
    return ag.multi_dim(li, ["l_returnflag", "l_linestatus"],
                        [sc.as_double(F.sum(sc.money("l_quantity"))).alias("sum_qty"),
                         F.count(F.lit(1)).alias("n")], mode, sets)


@register("ag5_rollup", _AG5_SELECT.format(g="ROLLUP (l_returnflag, l_linestatus)"))
def ag5_rollup(spark, sf):
    return _ag5(spark, sf, "rollup")


@register("ag5_cube", _AG5_SELECT.format(g="CUBE (l_returnflag, l_linestatus)"))
def ag5_cube(spark, sf):
    return _ag5(spark, sf, "cube")


@register("ag5_grouping_sets", _AG5_SELECT.format(g="GROUPING SETS ((l_returnflag), (l_linestatus), ())"))
def ag5_grouping_sets(spark, sf):
    return _ag5(spark, sf, "sets", [["l_returnflag"], ["l_linestatus"], []])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("ag6_pivot", "SELECT year, " + ", ".join(
    f"CAST(SUM(CASE WHEN c_mktsegment = '{s}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {s}"
    for s in SEGMENTS) + """
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_mktsegment, o_totalprice
      FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY year
""")
def ag6_pivot(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    j = o.select("o_custkey", F.year("o_orderdate").cast("int").alias("year"), sc.money("o_totalprice").alias("v")) \
         .join(c.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    p = ag.pivot(j, ["year"], "c_mktsegment", SEGMENTS, F.sum("v"))
    return p.select("year", *[sc.as_double(F.col(s)).alias(s) for s in SEGMENTS])


@register("ag7_percentiles", """
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.9), 4) AS p90
FROM orders GROUP BY 1
""")
def ag7_percentiles(spark, sf):
    o = _t(spark, sf, "orders")
    r = ag.percentiles(o, ["o_orderpriority"], "o_totalprice", [0.5, 0.9], ["o_orderkey"], ["p50", "p90"])
    return r.select("o_orderpriority", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


@register("ag7_by_brackets", """
SELECT l_returnflag, quantile_cont(CAST(round(l_extendedprice * 100) AS BIGINT), 0.05) AS p5, quantile_cont(CAST(round(l_extendedprice * 100) AS BIGINT), 0.5) AS p50,
       quantile_cont(CAST(round(l_extendedprice * 100) AS BIGINT), 0.99) AS p99
FROM lineitem GROUP BY 1
""")
def ag7_by_brackets(spark, sf):
    """Exact percentiles of line prices in cents, by narrowing brackets."""
    li = _t(spark, sf, "lineitem").select("l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    return ag.percentiles_by_brackets(li, ["l_returnflag"], "cents", [0.05, 0.5, 0.99], ["p5", "p50", "p99"], bracket_rows=2000)


# --- SQ (Spark SQL over the contract-checked tables) ---------------------------
_SQ1 = """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)
"""
_SQ2 = """
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal FROM customer c
WHERE c.c_acctbal > (SELECT avg(c2.c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey) * 1.5
"""
_SQ3 = f"""
WITH per_order AS (SELECT l_orderkey, SUM({REV}) AS rev FROM lineitem GROUP BY l_orderkey),
     per_cust AS (SELECT o.o_custkey, SUM(p.rev) AS rev, COUNT(*) AS n_orders
                  FROM per_order p JOIN orders o ON p.l_orderkey = o.o_orderkey GROUP BY o.o_custkey)
SELECT o_custkey, CAST(rev AS DOUBLE) AS revenue, n_orders FROM per_cust WHERE n_orders >= 10
"""


def _sql(spark, sf, text, tables):
    register_views(spark, sf, tables)
    return spark.sql(text)


@register("sq1_scalar_subquery", _SQ1)
def sq1_scalar_subquery(spark, sf):
    return _sql(spark, sf, _SQ1, ["orders"])


@register("sq2_correlated", _SQ2)
def sq2_correlated(spark, sf):
    return _sql(spark, sf, _SQ2, ["customer"])


@register("sq3_cte", _SQ3)
def sq3_cte(spark, sf):
    return _sql(spark, sf, _SQ3, ["lineitem", "orders"])


# --- WN ----------------------------------------------------------------------
@register("wn1_ranking", """
SELECT c_custkey, c_nationkey, c_acctbal,
       row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS row_number,
       rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank,
       dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS dense_rank
FROM customer
""")
def wn1_ranking(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return wn.rank_columns(c, ["c_nationkey"], ["c_acctbal"], ["c_custkey"], descending=True)


@register("wn2_offset", """
SELECT o_custkey, o_orderkey, o_totalprice,
       lag(o_totalprice) OVER w AS prev_o_totalprice, lead(o_totalprice) OVER w AS next_o_totalprice,
       first_value(o_totalprice) OVER wf AS first_o_totalprice, last_value(o_totalprice) OVER wf AS last_o_totalprice
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
       wf AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def wn2_offset(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return wn.offsets(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").drop("o_orderdate")


@register("wn3_running_moving", """
SELECT o_custkey, o_orderkey,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / COUNT(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
         AS moving_avg3
FROM orders
""")
def wn3_running_moving(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", sc.money("o_totalprice").alias("v"))
    order = ["o_orderdate", "o_orderkey"]
    r = wn.prefix_sums(o, ["o_custkey"], order, {"_run": F.col("v")})
    m = wn.moving_sum(r, ["o_custkey"], order, F.col("v"), 3, "_mv")
    return m.select("o_custkey", "o_orderkey", sc.as_double("_run").alias("running_total"),
                    (sc.as_double("_mv") / F.col("_mv_rows")).alias("moving_avg3"))


@register("wn4_share_of_group", """
SELECT c_custkey, c_nationkey,
       CAST(c_acctbal AS DOUBLE) / CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_nationkey) AS DOUBLE)
         AS share
FROM customer
""")
def wn4_share_of_group(spark, sf):
    """Group total on every row as aggregate + join back (combined map-side;
    a hot group is one row on the small side), so rows out = rows in. AQE
    sees the totals' real size and picks the join."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    tot = c.groupBy("c_nationkey").agg(sc.as_double(F.sum(sc.money("c_acctbal"))).alias("_tot"))
    j = c.join(tot, "c_nationkey", "left")
    return j.select("c_custkey", "c_nationkey", (F.col("c_acctbal") / F.col("_tot")).alias("share"))


@register("wn5_distribution", """
SELECT c_custkey, c_nationkey,
       ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS quartile,
       percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS percent_rank,
       cume_dist() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS cume_dist
FROM customer
""")
def wn5_distribution(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    q = wn.ntile(c, ["c_nationkey"], ["c_acctbal", "c_custkey"], 4, "quartile")
    d = wn.distribution(q, ["c_nationkey"], ["c_acctbal"], ["c_custkey"])
    return d.select("c_custkey", "c_nationkey", F.col("quartile").cast("bigint").alias("quartile"),
                    "percent_rank", "cume_dist")


@register("wn6_top_n", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 3
""")
def wn6_top_n(spark, sf):
    """``row_number() <= n``: Spark plans a partial WindowGroupLimit before
    the shuffle, so even a hot customer ships only n rows per map task."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    w = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey"))
    return o.withColumn("_rn", w).filter(F.col("_rn") <= 3).drop("_rn")


@register("wn7_global_ntile", """
SELECT o_orderkey, o_totalprice, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS decile
FROM orders
""")
def wn7_global_ntile(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return wn.ntile(o, [], ["o_totalprice", "o_orderkey"], 10, "decile")


# --- SL / RC -----------------------------------------------------------------
@register("sl1_top_k", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20
""")
def sl1_top_k(spark, sf):
    """Top-k report: the limit is the feature (TakeOrderedAndProject keeps k
    rows per task, then k overall)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(20)


@register("rc1_reconcile", """
WITH lines AS (
  SELECT l_orderkey AS o_orderkey,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
             * (1 + CAST(l_tax AS DECIMAL(18,2)))) AS v FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders)
SELECT COALESCE(o.o_orderkey, lines.o_orderkey) AS o_orderkey, CAST(o.v AS DOUBLE) AS left_value,
       CAST(lines.v AS DOUBLE) AS right_value,
       CASE WHEN o.o_orderkey IS NULL THEN 'missing_left' WHEN lines.o_orderkey IS NULL THEN 'missing_right'
            WHEN abs(o.v - lines.v) <= 0.01 THEN 'match' ELSE 'mismatch' END AS status
FROM o FULL OUTER JOIN lines ON o.o_orderkey = lines.o_orderkey
""")
def rc1_reconcile(spark, sf):
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(sc.revenue() * (F.lit(1) + sc.money("l_tax"))).alias("v"))
    return ag.reconcile(o.select("o_orderkey", sc.money("o_totalprice").alias("v")), lines,
                        ["o_orderkey"], "v", "v", tol=0.01)


_REPLICA_SQL = """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 2003 = 7 THEN 10 ELSE 0 END AS v FROM orders WHERE o_orderkey % 1999 <> 5
UNION ALL SELECT -o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_orderkey % 3001 = 9"""


@register("rc1_by_digest", f"""
WITH a AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders), b AS ({_REPLICA_SQL})
SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey, CAST(a.v AS DOUBLE) AS left_value, CAST(b.v AS DOUBLE) AS right_value,
       CASE WHEN a.o_orderkey IS NULL THEN 'missing_left' WHEN b.o_orderkey IS NULL THEN 'missing_right'
            WHEN a.v = b.v THEN 'match' ELSE 'mismatch' END AS status
FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey
""")
def rc1_by_digest(spark, sf):
    """Orders against a replica with a few rows changed, lost and added: only
    the key ranges whose digests differ are shuffled."""
    o = _t(spark, sf, "orders").select("o_orderkey", sc.money("o_totalprice").alias("v"))
    changed = F.when(F.col("o_orderkey") % 2003 == 7, F.lit(10)).otherwise(F.lit(0))
    replica = o.filter(F.col("o_orderkey") % 1999 != 5).select("o_orderkey", (F.col("v") + changed).cast(sc.MONEY).alias("v"))
    replica = replica.unionByName(o.filter(F.col("o_orderkey") % 3001 == 9).select((-F.col("o_orderkey")).alias("o_orderkey"), "v"))
    return ag.reconcile_by_digest(o, replica, ["o_orderkey"], "v")


@register("rc2_multiset_diff", """
WITH a AS (SELECT o_orderkey, o_custkey FROM orders),
     b AS (SELECT o.o_orderkey, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
     u AS (SELECT o_orderkey, o_custkey, 1 AS d FROM a UNION ALL SELECT o_orderkey, o_custkey, -1 FROM b),
     g AS (SELECT o_orderkey, o_custkey, SUM(d) AS net FROM u GROUP BY 1, 2 HAVING SUM(d) <> 0)
SELECT o_orderkey, o_custkey, CASE WHEN net > 0 THEN 'left_only' ELSE 'right_only' END AS side,
       CAST(abs(net) AS BIGINT) AS copies FROM g
""")
def rc2_multiset_diff(spark, sf):
    """Orders as listed vs orders as seen through their lines: orders
    without lines are left-only, every extra line a right-only copy."""
    o, li = _t(spark, sf, "orders"), _t(spark, sf, "lineitem")
    a = o.select("o_orderkey", "o_custkey")
    b = li.select(F.col("l_orderkey").alias("o_orderkey")).join(a, "o_orderkey")
    return ag.diff(a, b.select("o_orderkey", "o_custkey"))


# --- SC ----------------------------------------------------------------------
@register("sc1_dates", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), last_day(CAST(o_orderdate AS DATE))) AS INTEGER) AS days_left,
       CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo,
       CAST(isodow(o_orderdate) AS INTEGER) AS iso_dow
FROM orders
""")
def sc1_dates(spark, sf):
    o = _t(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", sc.month_start("o_orderdate").alias("month"),
                    F.trunc(d, "quarter").alias("quarter"), F.add_months(d, 3).alias("plus_3_months"),
                    F.last_day(d).alias("month_end"), F.datediff(F.last_day(d), d).cast("int").alias("days_left"),
                    F.year(d).alias("yr"), F.month(d).alias("mo"),
                    ((F.dayofweek(d) + 5) % 7 + 1).cast("int").alias("iso_dow"))


@register("sc2_strings", """
SELECT c_custkey, upper(trim(c_mktsegment)) AS seg, lower(c_name) AS name_lc,
       substring(c_name, 10, 9) AS name_no,
       regexp_replace(c_name, '[0-9]', '#', 'g') AS masked,
       concat_ws('|', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS seg_nation,
       CAST(length(c_name) AS INTEGER) AS name_len
FROM customer
""")
def sc2_strings(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", F.upper(F.trim("c_mktsegment")).alias("seg"), F.lower("c_name").alias("name_lc"),
                    F.substring("c_name", 10, 9).alias("name_no"),
                    F.regexp_replace("c_name", "[0-9]", "#").alias("masked"),
                    F.concat_ws("|", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("seg_nation"),
                    F.length("c_name").cast("int").alias("name_len"))


@register("sc3_timezone_days", """
SELECT CAST(timezone('Asia/Taipei', timezone('UTC', ts)) AS DATE) AS local_day, COUNT(*) AS n
FROM events GROUP BY 1
""")
def sc3_timezone_days(spark, sf):
    e = _t(spark, sf, "events")
    return e.groupBy(F.to_date(sc.to_local("ts", "UTC", "Asia/Taipei")).alias("local_day")).agg(
        F.count(F.lit(1)).alias("n"))
