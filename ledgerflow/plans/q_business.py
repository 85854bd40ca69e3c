"""BZ-1..5 registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import business as bz
from ..session import keep
from ..sources.tables import load
from .catalog import register

REV = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


def _t(spark, sf, *names):
    return [load(spark, sf, n) for n in names]


@register("bz1_sales_cube", f"""
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, r.r_name, n.n_name, c.c_mktsegment,
       CAST(grouping(r.r_name) + grouping(n.n_name) + grouping(c.c_mktsegment) AS INTEGER) AS level,
       CAST(SUM({REV}) AS DOUBLE) AS revenue,
       COUNT(DISTINCT o.o_orderkey) AS orders
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY CAST(date_trunc('month', o.o_orderdate) AS DATE), ROLLUP (r.r_name, n.n_name, c.c_mktsegment)
""")
def bz1_sales_cube(spark, sf):
    return bz.sales_cube(*_t(spark, sf, "lineitem", "orders", "customer", "nation", "region"))


_GEO = ["r_name", "n_name", "c_mktsegment"]


@register("bz1_distinct_rollup", """
SELECT r.r_name, n.n_name, c.c_mktsegment, CAST(grouping(r.r_name) + grouping(n.n_name) + grouping(c.c_mktsegment) AS INTEGER) AS level,
       COUNT(DISTINCT o.o_custkey) AS customers, COUNT(DISTINCT l.l_partkey) AS parts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ROLLUP (r.r_name, n.n_name, c.c_mktsegment)
""")
def bz1_distinct_rollup(spark, sf):
    """Distinct buying customers and parts sold at every level, from bitmaps
    of two batches of orders that are merged first."""
    li, o, c, n, r = _t(spark, sf, "lineitem", "orders", "customer", "nation", "region")
    geo = c.join(bz.geo_dim(n, r), c.c_nationkey == F.col("n_nationkey")).select("c_custkey", *_GEO)
    lines = li.select("l_orderkey", "l_partkey").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = keep(lines.join(geo, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey", "l_partkey", *_GEO), "bz1-lines")
    found = []
    for col, name in (("o_custkey", "customers"), ("l_partkey", "parts")):
        batches = [bz.distinct_bitmaps(lines.filter(F.col("o_orderkey") % 2 == k), _GEO, col) for k in (0, 1)]
        found.append(bz.distinct_rollup(bz.merge_bitmaps(batches[0].unionByName(batches[1]), _GEO), _GEO, name))
    same = [F.col(f"a.{d}").eqNullSafe(F.col(f"b.{d}")) for d in [*_GEO, "level"]]
    return found[0].alias("a").join(found[1].alias("b"), same).select(*[f"a.{d}" for d in _GEO], "a.level", "customers", "parts")


@register("bz2_mom_revenue", f"""
WITH m AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, SUM({REV}) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
spine AS (
  SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m),
f AS (SELECT s.month, COALESCE(m.revenue, 0) AS revenue FROM spine s LEFT JOIN m USING (month))
SELECT a.month, CAST(a.revenue AS DOUBLE) AS revenue, CAST(b.revenue AS DOUBLE) AS prev_revenue,
       CASE WHEN CAST(b.revenue AS DOUBLE) <> 0
            THEN CAST(a.revenue AS DOUBLE) / CAST(b.revenue AS DOUBLE) - 1 END AS change
FROM f a LEFT JOIN f b ON a.month = CAST(b.month + INTERVAL 1 MONTH AS DATE)
""")
def bz2_mom_revenue(spark, sf):
    li, o = _t(spark, sf, "lineitem", "orders")
    return bz.mom(bz.monthly_revenue(li, o), "revenue")


_COHORT_SQL = """
WITH act AS (SELECT DISTINCT o_custkey AS u, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
first AS (SELECT u, min(m) AS cohort_month FROM act GROUP BY u),
c AS (
  SELECT f.cohort_month,
         CAST((year(a.m) - year(f.cohort_month)) * 12 + month(a.m) - month(f.cohort_month) AS INTEGER) AS months_since,
         COUNT(*) AS active
  FROM act a JOIN first f USING (u) GROUP BY 1, 2)
SELECT c.cohort_month, c.months_since, c.active, s.active AS cohort_size,
       CAST(c.active AS DOUBLE) / s.active AS retention
FROM c JOIN c s ON s.cohort_month = c.cohort_month AND s.months_since = 0
"""


@register("bz3_cohort_retention", _COHORT_SQL)
def bz3_cohort_retention(spark, sf):
    (o,) = _t(spark, sf, "orders")
    return bz.cohort(o, "o_custkey", "o_orderdate")


@register("bz3_cohort_incremental", _COHORT_SQL)
def bz3_cohort_incremental(spark, sf):
    """The same retention from month bitmaps kept per customer: the orders
    come in three batches, the last of which overlaps the others."""
    (o,) = _t(spark, sf, "orders")
    state = None
    for batch in ("o_orderkey % 3 = 0", "o_orderkey % 3 <> 0 AND o_orderdate >= '1998-01-01'", "o_orderdate < '1999-01-01'"):
        bits = bz.month_bits(o.filter(batch), "o_custkey", "o_orderdate")
        state = keep(bits if state is None else bz.merge_month_bits(state, bits), "bz3-state")
    return bz.cohort_from_bits(state)


@register("bz4_rfm", """
WITH per AS (
  SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_d, COUNT(*) AS frequency,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary
  FROM orders GROUP BY o_custkey),
x AS (SELECT *, CAST(date_diff('day', last_d, (SELECT max(last_d) FROM per) + 1) AS INTEGER) AS recency FROM per)
SELECT o_custkey, recency, frequency, monetary,
       CAST(ntile(5) OVER (ORDER BY recency DESC, o_custkey) AS INTEGER) AS r_score,
       CAST(ntile(5) OVER (ORDER BY frequency, o_custkey) AS INTEGER) AS f_score,
       CAST(ntile(5) OVER (ORDER BY monetary, o_custkey) AS INTEGER) AS m_score,
       CAST(ntile(5) OVER (ORDER BY recency DESC, o_custkey) AS VARCHAR)
         || CAST(ntile(5) OVER (ORDER BY frequency, o_custkey) AS VARCHAR)
         || CAST(ntile(5) OVER (ORDER BY monetary, o_custkey) AS VARCHAR) AS rfm
FROM x
""")
def bz4_rfm(spark, sf):
    (o,) = _t(spark, sf, "orders")
    return bz.rfm(o)


_FUNNEL_WEEKS = """
WITH ev AS (
  SELECT user_id AS u, CAST(date_trunc('week', ts) AS DATE) AS week, ts, event_type AS k
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
{per},
wk AS (SELECT week, {counts} FROM per GROUP BY week),
st AS (
  SELECT week, 1 AS step, 'view' AS step_name, n0 AS users, n0 AS prev FROM wk
  UNION ALL SELECT week, 2, 'click', n1, n0 FROM wk
  UNION ALL SELECT week, 3, 'purchase', n2, n1 FROM wk)
SELECT week, step, step_name, CAST(users AS BIGINT) AS users,
       CASE WHEN prev > 0 THEN CAST(users AS DOUBLE) / prev END AS step_rate
FROM st
"""


@register("bz5_funnel", _FUNNEL_WEEKS.format(
    per="""per AS (SELECT u, week, max(CASE WHEN k='view' THEN 1 ELSE 0 END) AS h0,
                max(CASE WHEN k='click' THEN 1 ELSE 0 END) AS h1,
                max(CASE WHEN k='purchase' THEN 1 ELSE 0 END) AS h2 FROM ev GROUP BY u, week)""",
    counts="count_if(h0=1) AS n0, count_if(h0=1 AND h1=1) AS n1, count_if(h0=1 AND h1=1 AND h2=1) AS n2"))
def bz5_funnel(spark, sf):
    (e,) = _t(spark, sf, "events")
    return bz.funnel(e)


@register("bz5_funnel_ordered", _FUNNEL_WEEKS.format(
    per="""p0 AS (SELECT u, week, min(ts) AS t0 FROM ev WHERE k='view' GROUP BY u, week),
p1 AS (SELECT p0.u, p0.week, min(ev.ts) AS t1 FROM p0 JOIN ev ON ev.u = p0.u AND ev.week = p0.week
       AND ev.k = 'click' AND ev.ts > p0.t0 GROUP BY p0.u, p0.week),
p2 AS (SELECT p1.u, p1.week, min(ev.ts) AS t2 FROM p1 JOIN ev ON ev.u = p1.u AND ev.week = p1.week
       AND ev.k = 'purchase' AND ev.ts > p1.t1 GROUP BY p1.u, p1.week),
per AS (SELECT p0.u, p0.week, t0, t1, t2 FROM p0 LEFT JOIN p1 USING (u, week) LEFT JOIN p2 USING (u, week))""",
    counts="count(t0) AS n0, count(t1) AS n1, count(t2) AS n2"))
def bz5_funnel_ordered(spark, sf):
    (e,) = _t(spark, sf, "events")
    return bz.funnel(e, ordered=True)
