"""Aggregation (AG-1..7) and set comparison (RC-1, RC-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep
from .windows import join_back, row_index


# --- AG-5 --------------------------------------------------------------------
def multi_dim(df: DataFrame, dims: Sequence[str], measures: Sequence[Column], mode: str = "rollup",
              sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """ROLLUP / CUBE / GROUPING SETS with a ``level`` column (grouping_id as
    int) so a subtotal NULL is told apart from a data NULL."""
    lvl = F.grouping_id(*dims).cast("int").alias("level")
    if mode == "rollup":
        g = df.rollup(*dims)
    elif mode == "cube":
        g = df.cube(*dims)
    elif mode == "sets":
        g = df.groupingSets([list(s) for s in sets], *dims)
    else:
        raise ValueError(f"unknown mode {mode}")
    return g.agg(lvl, *measures)


# --- AG-6 --------------------------------------------------------------------
def pivot(df: DataFrame, rows: Sequence[str], col: str, values: Sequence, measure: Column) -> DataFrame:
    """Matrix with one column per listed value (the list keeps the plan free
    of a distinct-values pre-pass)."""
    return df.groupBy(*rows).pivot(col, list(values)).agg(measure)


# --- AG-7 --------------------------------------------------------------------
def percentiles(df: DataFrame, group_by: Sequence[str], value: str, ps: Sequence[float],
                tiebreak: Sequence[str], names: Sequence[str] | None = None,
                max_group_rows: int | None = None) -> DataFrame:
    """Exact ``percentile_cont`` per group without holding a group in memory.

    Rows are numbered in value order (skew-safe ``row_index``). Each p needs
    the values at positions floor/ceil of ``p*(n-1)``; all wanted positions
    of all groups (at most 2 per p per group) are fetched from the numbered
    rows by **one** equi-join on ``(group, position)``, then interpolated
    and folded back to one row per group by a partial aggregate.
    """
    G = list(group_by)
    names = list(names or [f"p{int(p * 100)}" for p in ps])
    v = df.filter(F.col(value).isNotNull()).select(*G, *tiebreak, F.col(value).alias("_v"))
    ranked = row_index(v, G, [F.col("_v").asc()] + [F.col(t).asc() for t in tiebreak], "_rn",
                       max_group_rows=max_group_rows)
    # Counted over every row: a group whose values are all NULL keeps its
    # row (positions 0 match nothing, so its percentiles are NULL).
    counts = df.groupBy(*G).agg(F.count(value).alias("_n"))
    want = []
    for p, nm in zip(ps, names):
        pos = F.lit(p) * (F.col("_n") - 1)
        want.append(F.struct(F.lit(nm).alias("_p"), (F.floor(pos) + 1).alias("_lo"),
                             (F.ceil(pos) + 1).alias("_hi"), (pos - F.floor(pos)).alias("_fr")))
    targets = counts.select(*G, F.explode(F.array(*want)).alias("_x")).select(*G, "_x.*")
    need = targets.select(*G, F.explode(F.array("_lo", "_hi")).alias("_rn")).distinct()
    got = join_back(need, ranked.select(*G, "_rn", "_v"), G + ["_rn"])
    t = join_back(targets, got.select(*G, F.col("_rn").alias("_lo"), F.col("_v").alias("_lov")), G + ["_lo"], "left")
    t = join_back(t, got.select(*G, F.col("_rn").alias("_hi"), F.col("_v").alias("_hiv")), G + ["_hi"], "left")
    lo, hi = F.col("_lov").cast("double"), F.col("_hiv").cast("double")
    t = t.withColumn("_val", lo + (hi - lo) * F.col("_fr"))
    return t.groupBy(*G).agg(*[F.max(F.when(F.col("_p") == nm, F.col("_val"))).alias(nm) for nm in names])


#: Grid of quantiles that a round looks at, the sketch's accuracy, and the
#: rows in a bracket from which its values are ranked exactly.
GRID, SKETCH, BRACKET_ROWS = 128, 2048, 50_000


def percentiles_by_brackets(df: DataFrame, group_by: Sequence[str], value: str, ps: Sequence[float], names: Sequence[str] | None = None,
                            bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Exact ``percentile_cont`` per group, by narrowing brackets: no sort of
    all rows, no numbering.

    A bracket is a range of values that holds the two ranks a percentile
    interpolates between. Each round sketches the values inside every bracket
    (``percentile_approx``, mergeable, combined map-side) and takes the grid
    cells around the ranks as the next bracket; exact counts of the rows below
    and inside it say whether a bound holds, and one that does not stays as
    it was. When no bracket has more than ``bracket_rows`` rows, or a round
    narrows none (then nearly all rows inside are copies of a value or two),
    the values inside are ranked, copies counted together. Rounds grow with
    the logarithm of the largest group.
    """
    G = list(group_by)
    names = list(names or [f"p{int(p * 100)}" for p in ps])
    v = df.select(*G, F.col(value).alias("_v"))
    one = v.groupBy(*G).agg(F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    pos = F.col("_q") * (F.col("_n") - 1)
    spec = F.explode(F.array(*[F.struct(F.lit(nm).alias("_p"), F.lit(float(q)).alias("_q")) for q, nm in zip(ps, names)])).alias("_x")
    t = one.select(*G, "_n", "_min", "_max", spec).select(*G, "_n", "_min", "_max", "_x.*")
    t = keep(t.select(*G, "_p", F.floor(pos).alias("_a"), F.ceil(pos).alias("_b"), (pos - F.floor(pos)).alias("_fr"),
                      F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), F.lit(0).cast("bigint").alias("_below"), F.col("_n").alias("_in")), "ag7-brackets")
    on = G + ["_p"]

    def inside(bounds: DataFrame) -> DataFrame:
        """(group, percentile, value) of the rows inside brackets."""
        per_group = bounds.groupBy(*G).agg(F.collect_list(F.struct("_p", "_lo", "_hi")).alias("_all"))  # one entry per percentile
        x = join_back(v.filter("_v is not null"), per_group, G)
        hit = F.filter("_all", lambda b: (F.col("_v") >= b["_lo"]) & (F.col("_v") <= b["_hi"]))
        return x.select(*G, "_v", F.explode(hit).alias("_h")).select(*G, F.col("_h._p").alias("_p"), "_v")

    before = None
    while True:
        wide = t.filter((F.col("_in") > bracket_rows) & (F.col("_lo") < F.col("_hi")))
        left = wide.agg(F.count(F.lit(1)), F.sum("_in")).first()  # two numbers
        if not left[0] or left == before:
            break
        before = left
        grid = inside(wide).groupBy(*on).agg(F.percentile_approx("_v", F.lit([i / GRID for i in range(GRID + 1)]), SKETCH).alias("_g"))
        x = join_back(t, grid, on, "left")
        # The cells around the wanted ranks, one more on either side.
        cell = lambda at, by: F.element_at("_g", (F.greatest(F.lit(0), F.least(F.lit(GRID), F.floor((at - F.col("_below")) * GRID / F.col("_in")) + by)) + 1).cast("int"))
        x = x.withColumn("_lo2", F.coalesce(cell(F.col("_a"), -1), "_lo")).withColumn("_hi2", F.coalesce(cell(F.col("_b"), 2), "_hi"))
        x = keep(x.drop("_g"), "ag7-proposed")
        bounds = x.groupBy(*G).agg(F.collect_list(F.struct("_p", "_lo2", "_hi2")).alias("_all"))
        rows = join_back(v.filter("_v is not null"), bounds, G).select(*G, "_v", F.explode("_all").alias("_h"))
        counts = rows.groupBy(*G, F.col("_h._p").alias("_p")).agg(F.count_if(F.col("_v") < F.col("_h._lo2")).alias("_c"), F.count_if(F.col("_v") <= F.col("_h._hi2")).alias("_d"))
        x = join_back(x, counts, on, "left")
        low_ok, high_ok = F.col("_c") <= F.col("_a"), F.col("_d") > F.col("_b")
        below = F.when(low_ok, F.col("_c")).otherwise(F.col("_below"))
        upto = F.when(high_ok, F.col("_d")).otherwise(F.col("_below") + F.col("_in"))
        t = keep(x.select(*G, "_p", "_a", "_b", "_fr", F.when(low_ok, F.col("_lo2")).otherwise(F.col("_lo")).alias("_lo"),
                          F.when(high_ok, F.col("_hi2")).otherwise(F.col("_hi")).alias("_hi"), below.alias("_below"), (upto - below).alias("_in")), "ag7-brackets")
    # At most bracket_rows values to a bracket, or one: ranked by value, copies counted together.
    some = inside(t).groupBy(*on, "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*on).orderBy("_v"))
    some = join_back(some.withColumn("_upto", upto), t.select(*on, "_a", "_b", "_fr", "_below"), on)
    holds = lambda at: (at >= F.col("_below") + F.col("_upto") - F.col("_c")) & (at < F.col("_below") + F.col("_upto"))
    got = some.groupBy(*on).agg(F.max(F.when(holds(F.col("_a")), F.col("_v"))).cast("double").alias("_x"),
                                F.max(F.when(holds(F.col("_b")), F.col("_v"))).cast("double").alias("_y"), F.max("_fr").alias("_f"))
    got = got.withColumn("_val", F.col("_x") + (F.col("_y") - F.col("_x")) * F.col("_f"))
    wide = got.groupBy(*G).agg(*[F.max(F.when(F.col("_p") == nm, F.col("_val"))).alias(nm) for nm in names])
    return join_back(one.select(*G), wide, G, "left")


# --- RC-1 --------------------------------------------------------------------
def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], a_col: str, b_col: str,
              tol: float = 0.0) -> DataFrame:
    """Full outer compare of one keyed measure per side.

    status: match | mismatch | missing_left | missing_right. NULL against
    NULL is a match; NULL against a value a mismatch. Each side must be at
    key grain (aggregate first, see ``joins.safe_join``).
    """
    K = list(keys)
    la = a.select(*K, F.col(a_col).alias("left_value"), F.lit(True).alias("_in_a"))
    rb = b.select(*K, F.col(b_col).alias("right_value"), F.lit(True).alias("_in_b"))
    j = la.join(rb, K, "full_outer")
    lv, rv = F.col("left_value"), F.col("right_value")
    status = (F.when(F.col("_in_a").isNull(), "missing_left")
              .when(F.col("_in_b").isNull(), "missing_right")
              .when(lv.isNull() & rv.isNull(), "match")
              .when(lv.isNull() | rv.isNull(), "mismatch")
              .when(F.abs(lv - rv) <= F.lit(tol), "match")
              .otherwise("mismatch"))
    return j.select(*K, lv.cast("double").alias("left_value"), rv.cast("double").alias("right_value"),
                    status.alias("status"))


#: Parts that a level of digests divides a range of key hashes into.
DIGEST_FAN = 1024


def _digests(df: DataFrame, keys: Sequence[str], value: str, level: int) -> DataFrame:
    """(range, count and 128 bits of the rows in it), whatever their order:
    sums of the halves of two hashes of (keys, value)."""
    x = df.select(_range(keys, level).alias("part"), F.xxhash64(F.lit(1), *keys, value).alias("p"), F.xxhash64(F.lit(2), *keys, value).alias("q"))
    halves = [F.sum(part).alias(f"{h}{i}") for h in "pq" for i, part in enumerate((F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(h, 32)))]
    return x.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *halves)


def _range(keys: Sequence[str], level: int) -> Column:
    """Number of the range of key hashes that a row lies in, ``DIGEST_FAN`` ** level of them."""
    return F.pmod(F.xxhash64(*keys), F.lit(DIGEST_FAN ** level))


def differing_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, levels: int = 2) -> DataFrame:
    """(part) of the last level whose digests differ, at most ``DIGEST_FAN``
    ** levels numbers. Each level digests only what lies in ranges that
    differed one level up."""
    parts = None
    for level in range(1, levels + 1):
        sides = []
        for df in (a, b):
            if parts is not None:
                # DIGEST_FAN ** (level - 1) numbers at most.
                df = df.withColumn("_up", _range(keys, level - 1)).join(F.broadcast(parts.withColumnRenamed("part", "_up")), "_up", "left_semi")
            sides.append(_digests(df, keys, value, level))
        cols = [c for c in sides[0].columns if c != "part"]
        both = sides[0].toDF("part", *cols).alias("l").join(sides[1].alias("r"), "part", "full_outer")
        same = F.lit(True)
        for c in cols:
            same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        parts = keep(both.filter(~same).select("part"), f"rc1-level{level}")
    return parts


def reconcile_by_digest(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tol: float = 0.0, levels: int = 2) -> DataFrame:
    """``reconcile`` of two large tables that are mostly equal: digests of key
    ranges are compared level by level, and only rows in ranges that differ are
    shuffled. Rows of equal ranges match and come from ``a`` as they are; of
    equal tables nothing moves but digests. Two different ranges pass for
    equal only if 128 bits of hash sums agree."""
    K = list(keys)
    x, y = a.select(*K, value), b.select(*K, value)
    parts = differing_ranges(x, y, K, value, levels)
    near = F.broadcast(parts.withColumnRenamed("part", "_part"))  # DIGEST_FAN ** levels numbers at most
    x, y = x.withColumn("_part", _range(K, levels)), y.withColumn("_part", _range(K, levels))
    v = F.col(value).cast("double")
    equal = x.join(near, "_part", "left_anti").select(*K, v.alias("left_value"), v.alias("right_value"), F.lit("match").alias("status"))
    return equal.unionByName(reconcile(x.join(near, "_part", "left_semi"), y.join(near, "_part", "left_semi"), K, value, value, tol))


# --- RC-2 --------------------------------------------------------------------
def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways in one aggregate: rows of ``a`` beyond
    their copies in ``b`` (side 'left_only') and the reverse, with the
    number of surplus ``copies``. Equivalent to ``exceptAll`` each way."""
    cols = a.columns
    u = a.select(*cols, F.lit(1).alias("_d")).unionByName(b.select(*cols, F.lit(-1).alias("_d")))
    g = u.groupBy(*cols).agg(F.sum("_d").alias("_net")).filter(F.col("_net") != 0)
    return g.select(*cols, F.when(F.col("_net") > 0, "left_only").otherwise("right_only").alias("side"),
                    F.abs(F.col("_net")).cast("bigint").alias("copies"))
