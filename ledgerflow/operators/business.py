"""Business analytics (BZ-1..5) as Spark plans.

Every plan aggregates before it joins, so the big fact tables are reduced
map-side before any shuffle:

* lineitem -> order grain (partial aggregate on ``l_orderkey``), then one
  join with orders; an order then carries exactly one customer and month,
  so "distinct orders" is a plain count and the rollup needs no distinct
  expansion.
* month-over-month uses a self equi-join on ``month = prev_month + 1``
  rather than an unpartitioned ``lag`` window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_double, month_start, months_between_whole, revenue_units, units_to_money, week_start
from ..session import keep
from .windows import ntile


def order_revenue(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, rev decimal) — line revenue summed to the order grain.

    The per-line sum runs on exact bigint units (an order has a handful of
    lines, so no overflow); the order total is then exact decimal."""
    return lineitem.groupBy("l_orderkey").agg(units_to_money(F.sum(revenue_units())).alias("rev"))


def geo_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """(n_nationkey, n_name, r_name): the two tiny dimensions, pre-joined."""
    r = region.select("r_regionkey", "r_name")
    return nation.join(r, nation.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


# --- BZ-1 --------------------------------------------------------------------
def sales_cube(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
               nation: DataFrame, region: DataFrame) -> DataFrame:
    """Revenue and order count by month with a rollup over region > nation >
    segment. ``level`` = number of rolled-up dimensions (0 = finest)."""
    per_order = order_revenue(lineitem)
    o = orders.select("o_orderkey", "o_custkey", month_start("o_orderdate").alias("month"))
    om = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    cust_month = om.groupBy("o_custkey", "month").agg(
        F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("n_orders"))
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation/region are a few KB on disk: Spark's size-checked planner
    # broadcasts them; no hint needed.
    c = c.join(geo_dim(nation, region), c.c_nationkey == F.col("n_nationkey"))
    x = cust_month.join(c, cust_month.o_custkey == c.c_custkey)
    dims = ["r_name", "n_name", "c_mktsegment"]
    sets = [["month"] + dims[:i] for i in range(len(dims), -1, -1)]
    level = (F.grouping("r_name") + F.grouping("n_name") + F.grouping("c_mktsegment")).cast("int")
    return x.groupingSets(sets, "month", *dims).agg(
        level.alias("level"),
        as_double(F.sum("rev")).alias("revenue"),
        F.sum("n_orders").cast("bigint").alias("orders"),
    )


def distinct_bitmaps(df: DataFrame, dims: Sequence[str], col: str) -> DataFrame:
    """(dims, _part, _bits): which values of the integer column ``col`` each
    group has, 32,768 numbers to a bitmap of 4 KB. Bitmaps of batches merge
    with ``merge_bitmaps``. Made for dense numbers: a group's bitmaps are as
    many as the ranges of numbers it touches. Rows are made distinct first,
    by a hash aggregate in every task. A NULL value counts for nothing, but
    its group stays."""
    x = df.select(*dims, F.col(col).cast("bigint").alias("_v")).distinct()
    return x.groupBy(*dims, F.bitmap_bucket_number("_v").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("_bits"))


def merge_bitmaps(bitmaps: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer dimensions, or of several batches, from finer ones."""
    return bitmaps.groupBy(*dims, "_part").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def distinct_rollup(bitmaps: DataFrame, dims: Sequence[str], name: str) -> DataFrame:
    """(dims, level, name): distinct values at every level of a rollup over
    ``dims``. A level's bitmaps are those of the level below, merged, so rows
    are read and made distinct once, whatever the number of levels."""
    types = {f.name: f.dataType for f in bitmaps.schema.fields}
    out, at = None, keep(bitmaps, "bitmaps")
    for level in range(len(dims) + 1):
        left = list(dims[:len(dims) - level])
        if level:
            at = merge_bitmaps(at, left)
        one = at.groupBy(*left).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).cast("bigint").alias(name))
        one = one.select(*[F.col(d) if d in left else F.lit(None).cast(types[d]).alias(d) for d in dims], F.lit(level).alias("level"), name)
        out = one if out is None else out.unionByName(one)
    return out


# --- BZ-2 --------------------------------------------------------------------
def month_spine(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Every month from the first to the last (one row per month; the range
    comes from one global aggregate)."""
    b = df.agg(F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias(month_col))


def mom(monthly: DataFrame, measure: str, month_col: str = "month") -> DataFrame:
    """Month-over-month change with a gap-free month spine. Missing month = 0.
    ``change`` = cur / prev - 1, NULL when prev is 0 or NULL."""
    # ``monthly`` has a row per calendar month, so it fits in one map; the
    # spine, the month and its predecessor are all read from it, and what
    # made ``monthly`` runs once.
    m, v = F.col(month_col), F.col(measure)
    one = monthly.filter(m.isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(m, v))).alias("_by"),
                                            F.min(m).alias("_lo"), F.max(m).alias("_hi"))
    x = one.select("_by", "_lo", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias(month_col))
    zero = F.lit(0).cast(monthly.schema[measure].dataType)
    before = F.add_months(m, -1)
    x = x.select(month_col, F.coalesce(F.try_element_at("_by", m), zero).alias("_cur"),
                 F.when(m > F.col("_lo"), F.coalesce(F.try_element_at("_by", before), zero)).alias("_prev"))
    cur, pv = as_double(F.col("_cur")), as_double(F.col("_prev"))
    return x.select(month_col, cur.alias(measure), pv.alias(f"prev_{measure}"),
                    F.when(pv != 0, cur / pv - 1).alias("change"))


def monthly_revenue(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    per_order = order_revenue(lineitem)
    o = orders.select("o_orderkey", month_start("o_orderdate").alias("month"))
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey).groupBy("month").agg(
        F.sum("rev").alias("revenue"))


# --- BZ-3 --------------------------------------------------------------------
def cohort(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """Cohort retention: cohort month x months since -> active users, rate.

    Active months per user are de-duplicated first (partial aggregate), the
    cohort month is their minimum, and the final counts are plain counts.
    """
    return _retention(activity.select(F.col(user).alias("_u"), month_start(ts).alias("_m")).distinct())


def _retention(act: DataFrame) -> DataFrame:
    """From the distinct (_u, _m)."""
    first = act.groupBy("_u").agg(F.min("_m").alias("cohort_month"))
    j = act.join(first, "_u")
    k = months_between_whole(F.col("_m"), F.col("cohort_month")).alias("months_since")
    counts = j.groupBy("cohort_month", k).agg(F.count(F.lit(1)).alias("active"))
    size = counts.filter(F.col("months_since") == 0).select(
        "cohort_month", F.col("active").alias("cohort_size"))
    return counts.join(size, "cohort_month").select(
        "cohort_month", "months_since", "active", "cohort_size",
        (F.col("active") / F.col("cohort_size")).alias("retention"))


def month_bits(activity: DataFrame, user: str, ts: str) -> DataFrame:
    """(_u, _word, _bits): the months in which a user was active, 64 of them
    to a number. What a batch knows of a user is a row or two."""
    m = (F.year(ts) * 12 + F.month(ts) - 1).cast("int")
    x = activity.filter(F.col(ts).isNotNull()).select(F.col(user).alias("_u"), m.alias("_m"))
    bit = F.expr("shiftleft(1L, pmod(_m, 64))")
    return x.groupBy("_u", F.floor(F.col("_m") / 64).cast("int").alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def merge_month_bits(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State and batch as one: months are only added, so a batch may come
    twice, late, or overlap others."""
    return state.unionByName(batch).groupBy("_u", "_word").agg(F.bit_or("_bits").alias("_bits"))


def cohort_from_bits(state: DataFrame) -> DataFrame:
    """``cohort`` of all the activity that was merged into ``state``."""
    months = F.expr("filter(sequence(0, 63), i -> (shiftright(_bits, i) & 1) = 1)")
    m = F.col("_word") * 64 + F.col("_i")
    act = state.select("_u", "_word", F.explode(months).alias("_i")).select("_u", F.make_date((F.floor(m / 12)).cast("int"), (F.pmod(m, F.lit(12)) + 1).cast("int"), F.lit(1)).alias("_m"))
    return _retention(act)


# --- BZ-4 --------------------------------------------------------------------
def rfm(orders: DataFrame, cust: str = "o_custkey", ts: str = "o_orderdate",
        amount: str = "o_totalprice", as_of=None, buckets: int = 5,
        max_group_rows: int | None = None) -> DataFrame:
    """RFM quintiles (5 = best on each axis) and a three-digit segment code.

    ``as_of`` defaults to the day after the last order. The three exact
    global ntiles use the range-split plan (no single-partition window).
    """
    # One row per customer, written once: read by the scalars and three range splits.
    per = keep(orders.groupBy(cust).agg(
        F.max(F.to_date(ts)).alias("_last"), F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col(amount).cast("decimal(18,2)")).alias("_m")), "rfm-customers")
    # Scalars from one global aggregate; they become literals in the plan.
    n, last = per.agg(F.count(F.lit(1)), F.max("_last")).first()
    as_of_col = F.date_add(F.lit(last), 1) if as_of is None else F.lit(as_of).cast("date")
    per = per.select(cust, F.datediff(as_of_col, F.col("_last")).cast("int").alias("recency"),
                     F.col("frequency").cast("bigint").alias("frequency"),
                     as_double(F.col("_m")).alias("monetary"))
    per = ntile(per, [], [F.col("recency").desc(), F.col(cust).asc()], buckets, "r_score",
                max_group_rows=max_group_rows, rows=n)
    per = ntile(per, [], [F.col("frequency").asc(), F.col(cust).asc()], buckets, "f_score",
                max_group_rows=max_group_rows, rows=n)
    per = ntile(per, [], [F.col("monetary").asc(), F.col(cust).asc()], buckets, "m_score",
                max_group_rows=max_group_rows, rows=n)
    return per.withColumn("rfm", F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                                          F.col("m_score").cast("string")))


# --- BZ-5 --------------------------------------------------------------------
DEFAULT_STEPS = ("view", "click", "purchase")


def funnel(events: DataFrame, steps: Sequence[str] = DEFAULT_STEPS, ordered: bool = False,
           user: str = "user_id", ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """Weekly funnel (Monday weeks): users reaching each step and step rates.

    Unordered: the user did every step up to this one in the week.
    Ordered: step i's earliest time is strictly after the chosen time of step
    i-1 (chosen = earliest qualifying). Each step is one partial aggregate per
    (user, week) joined back; a hot user-week is combined map-side.
    """
    ev = events.filter(F.col(kind).isin(list(steps))).select(
        F.col(user).alias("_u"), week_start(ts).alias("week"), F.col(ts).alias("_t"), F.col(kind).alias("_k"))
    if not ordered:
        per = ev.groupBy("_u", "week").agg(
            *[F.max((F.col("_k") == s).cast("int")).alias(f"_h{i}") for i, s in enumerate(steps)])
        reached = []
        acc = F.lit(True)
        for i in range(len(steps)):
            acc = acc & (F.col(f"_h{i}") == 1)
            reached.append(F.count_if(acc).alias(f"_n{i}"))
        wk = per.groupBy("week").agg(*reached)
    else:
        per = ev.filter(F.col("_k") == steps[0]).groupBy("_u", "week").agg(F.min("_t").alias("_t0"))
        for i in range(1, len(steps)):
            nxt = ev.filter(F.col("_k") == steps[i]).join(per.select("_u", "week", f"_t{i-1}"), ["_u", "week"])
            nxt = nxt.filter(F.col("_t") > F.col(f"_t{i-1}")).groupBy("_u", "week").agg(F.min("_t").alias(f"_t{i}"))
            per = per.join(nxt, ["_u", "week"], "left")
        wk = per.groupBy("week").agg(*[F.count(f"_t{i}").alias(f"_n{i}") for i in range(len(steps))])
    stack = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("step_name"),
                 F.col(f"_n{i}").cast("bigint").alias("users"),
                 (F.col(f"_n{i-1}") if i > 0 else F.col("_n0")).alias("_prev"))
        for i, s in enumerate(steps)])).alias("_s")
    out = wk.select("week", stack).select("week", "_s.*")
    return out.select("week", "step", "step_name", "users",
                      F.when(F.col("_prev") > 0, F.col("users") / F.col("_prev")).alias("step_rate"))
