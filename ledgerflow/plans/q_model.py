"""NF-1..5 and LY-1 registered queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import dependencies as fd
from ..operators import model as nf
from ..operators import quality as dq
from ..session import keep, scratch_path
from ..sources.tables import load
from .catalog import register
from .q_quality import ORDERS_CONTRACT, _DQ11_SQL


def _t(spark, sf, name):
    return load(spark, sf, name)


@register("nf1_to_1nf", """
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, parts[pos] AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d,
     LATERAL (SELECT unnest(generate_series(1, len(parts))) AS pos) p
""")
def nf1_to_1nf(spark, sf):
    """Documents split into their lines (text is a multi-valued column)."""
    d = _t(spark, sf, "documents")
    return nf.to_1nf(d, ["doc_id"], "text", "\n", "line")


@register("nf2_fd_check", """
SELECT c_nationkey, COUNT(DISTINCT c_mktsegment) AS n_values FROM customer GROUP BY 1 HAVING COUNT(DISTINCT c_mktsegment) > 1
UNION ALL
SELECT o_custkey, COUNT(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY 1 HAVING COUNT(*) > 1
""")
def nf2_fd_check(spark, sf):
    """Two dependencies a 3NF design would need and the data breaks:
    nation -> segment, customer -> priority."""
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    a = nf.check_fd(c, ["c_nationkey"], ["c_mktsegment"]).select(
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "n_values")
    b = nf.check_fd(o, ["o_custkey"], ["o_orderpriority"]).select(
        F.col("o_custkey").alias("c_nationkey"), "n_values")
    return a.unionByName(b)


_WIDE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "o_custkey", "o_orderdate",
              "o_orderstatus", "c_name", "c_nationkey", "c_mktsegment"]
_SPEC = {
    "line": ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
    "order": ["l_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
    "customer": ["o_custkey", "c_name", "c_nationkey", "c_mktsegment"],
}


@register("nf3_decompose", """
WITH w AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderdate, o_orderstatus,
                  c_name, c_nationkey, c_mktsegment
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
SELECT 'line' AS part, COUNT(*) AS n_rows FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity FROM w)
UNION ALL SELECT 'order', COUNT(*) FROM (SELECT DISTINCT l_orderkey, o_custkey, o_orderdate, o_orderstatus FROM w)
UNION ALL SELECT 'customer', COUNT(*) FROM (SELECT DISTINCT o_custkey, c_name, c_nationkey, c_mktsegment FROM w)
UNION ALL SELECT 'wide_distinct', COUNT(*) FROM w
UNION ALL SELECT 'lost_or_spurious', 0
""")
def nf3_decompose(spark, sf):
    """Wide sales rows split into line / order / customer tables keyed by
    natural keys; lossless because the joined parts' keys are unique and not
    NULL (Heath), so nothing is rejoined. Their sizes come from the same
    aggregates."""
    wide = _wide(spark, sf)
    parts = nf.decompose(wide, _SPEC)
    proof = keep(nf.lossless_by_keys(parts, [("line", []), ("order", ["l_orderkey"]), ("customer", ["o_custkey"])]), "nf3-proof")
    line = parts["line"].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("line").alias("part"), "n_rows")
    w = wide.distinct().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("wide_distinct").alias("part"), "n_rows")
    lost = proof.agg(F.sum(F.col("repeated_keys") + F.col("null_keys")).cast("bigint").alias("n_rows")).select(
        F.lit("lost_or_spurious").alias("part"), "n_rows")
    return proof.select("part", "n_rows").unionByName(line).unionByName(w).unionByName(lost)


#: Rows to a file of the wide table, so that no scan task sorts or hashes many millions.
WIDE_FILE_ROWS = 50_000


def _wide(spark, sf):
    """Lines with their order and customer, written once; every part then
    scans only its own columns."""
    li, o, c = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "customer")
    return keep(li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey).select(*_WIDE_COLS), "nf3-wide", WIDE_FILE_ROWS)


_WIDE_SQL = f"""SELECT {', '.join(_WIDE_COLS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
_FD_COLS = ["o_custkey", "o_orderdate", "o_orderstatus", "c_name", "c_nationkey", "c_mktsegment"]
_LEFT_SIDES = [list(x) for n in (1, 2) for x in combinations(_FD_COLS, n)]


def _holds_sql(x, a):
    return f"SELECT '{','.join(x)}' AS x, '{a}' AS a FROM (SELECT 1 FROM (SELECT DISTINCT {', '.join(x)}, {a} FROM w) GROUP BY {', '.join(x)} HAVING COUNT(*) > 1 LIMIT 1) HAVING COUNT(*) = 0"


@register("nf3_discover_fds", f"""
WITH w AS (SELECT DISTINCT {', '.join(_FD_COLS)} FROM orders JOIN customer ON o_custkey = c_custkey),
held AS ({' UNION ALL '.join(_holds_sql(x, a) for x in _LEFT_SIDES for a in _FD_COLS if a not in x)})
SELECT x AS left_side, a AS right_side FROM held h
WHERE NOT EXISTS (SELECT 1 FROM held s WHERE s.a = h.a AND length(s.x) < length(h.x) AND list_contains(string_split(h.x, ','), s.x))
""")
def nf3_discover_fds(spark, sf):
    """Every minimal dependency with up to two columns on the left among
    orders joined to their customers."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    rows = keep(o.join(c, F.col("o_custkey") == c.c_custkey).select(*_FD_COLS), "nf3-fds")
    fds = fd.discover(rows, _FD_COLS, max_left=2)
    at = _FD_COLS.index
    return spark.createDataFrame(sorted((",".join(sorted(x, key=at)), a) for x, a in fds), "left_side string, right_side string")


_LINE, _ORDER, _CUSTOMER = (",".join(_SPEC[p]) for p in ("line", "order", "customer"))


@register("nf3_synthesize", f"""
WITH w AS ({_WIDE_SQL})
SELECT '{_LINE}' AS key, '{_LINE}' AS columns, COUNT(*) AS n_rows, 0 AS repeated_keys FROM (SELECT DISTINCT {_LINE} FROM w)
UNION ALL SELECT 'l_orderkey', '{_ORDER}', COUNT(*), COUNT(*) - COUNT(DISTINCT l_orderkey) FROM (SELECT DISTINCT {_ORDER} FROM w)
UNION ALL SELECT 'o_custkey', '{_CUSTOMER}', COUNT(*), COUNT(*) - COUNT(DISTINCT o_custkey) FROM (SELECT DISTINCT {_CUSTOMER} FROM w)
""")
def nf3_synthesize(spark, sf):
    """The line, order and customer tables found from the wide rows alone:
    dependencies discovered, covered, synthesised, and each part's key proven."""
    wide = _wide(spark, sf)
    found = fd.synthesize(_WIDE_COLS, fd.discover(wide, _WIDE_COLS))
    parts = nf.decompose(wide, {i: cols for i, (_, cols) in enumerate(found)}, {i: key for i, (key, _) in enumerate(found)})
    out = None
    for i, (key, cols) in enumerate(found):
        one = nf.key_counts(parts[i], key)
        one = one.select(F.lit(",".join(key)).alias("key"), F.lit(",".join(cols)).alias("columns"), "n_rows", "repeated_keys")
        out = one if out is None else out.unionByName(one)
    return out


_KEY_COLUMNS = {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"],
                "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
                "documents": ["doc_id"], "labels": ["doc_id"]}
_ALL_KEYS = [(t, c) for t, cols in _KEY_COLUMNS.items() for c in cols]


@register("dq6_inclusions", "\nUNION ALL\n".join(
    f"SELECT '{t}.{c}' AS \"column\", '{u}.{d}' AS refers_to, (SELECT COUNT(DISTINCT {c}) FROM {t}) AS n_values, (SELECT COUNT(DISTINCT {d}) FROM {u}) AS n_target "
    f"WHERE NOT EXISTS (SELECT {c} FROM {t} WHERE {c} IS NOT NULL EXCEPT SELECT {d} FROM {u})"
    for t, c in _ALL_KEYS for u, d in _ALL_KEYS if (t, c) != (u, d)))
def dq6_inclusions(spark, sf):
    """Which key columns refer to which, found from the values of all tables."""
    return fd.inclusions({t: (_t(spark, sf, t), cols) for t, cols in _KEY_COLUMNS.items()})


_KEY_SETS = [["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_partkey"],
             ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]]


@register("nf4_candidate_keys", "\nUNION ALL\n".join(
    f"SELECT '{','.join(s)}' AS key_set, (SELECT COUNT(*) FROM (SELECT DISTINCT {','.join(s)} FROM lineitem)) AS n_distinct, "
    f"(SELECT COUNT(*) FROM lineitem) AS n_rows, "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT {','.join(s)} FROM lineitem)) = (SELECT COUNT(*) FROM lineitem) AS is_key"
    for s in _KEY_SETS))
def nf4_candidate_keys(spark, sf):
    return nf.candidate_keys(_t(spark, sf, "lineitem"), _KEY_SETS)


_NF5_SQL = f"""
WITH keys AS (
  SELECT 'missing_key' AS check_name, 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS object,
         CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_issues
  FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
  UNION ALL
  SELECT 'missing_key', 'orders', 'o_orderkey', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
  FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderkey)),
orph AS (
  SELECT 'orphans' AS check_name, 'orders' AS table_name, 'o_custkey' AS object,
         CAST(count_if(o_custkey NOT IN (SELECT c_custkey FROM customer)) AS BIGINT) AS n_issues FROM orders
  UNION ALL
  SELECT 'orphans', 'labels', 'doc_id', CAST(count_if(doc_id NOT IN (SELECT doc_id FROM documents)) AS BIGINT) FROM labels),
fd AS (
  SELECT 'fd_violation' AS check_name, 'customer' AS table_name, 'c_nationkey->c_mktsegment' AS object,
         CAST(COUNT(*) AS BIGINT) AS n_issues
  FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING COUNT(DISTINCT c_mktsegment) > 1)),
mv AS (
  SELECT 'multi_valued' AS check_name, 'documents' AS table_name, 'text' AS object,
         CAST(count_if(strpos(text, chr(10)) > 0) AS BIGINT) AS n_issues FROM documents),
allnull AS (
  SELECT 'all_null' AS check_name, 'labels' AS table_name, c AS object, CAST(CASE WHEN nn = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_issues
  FROM (SELECT 'quality' AS c, COUNT(quality) AS nn FROM labels UNION ALL SELECT 'toxic', COUNT(toxic) FROM labels)),
wt AS (
  SELECT 'wrong_type' AS check_name, 'orders' AS table_name, 'contract' AS object, CAST(COUNT(*) AS BIGINT) AS n_issues
  FROM ({_DQ11_SQL}) x WHERE problem = 'type')
SELECT * FROM keys UNION ALL SELECT * FROM orph UNION ALL SELECT * FROM fd UNION ALL SELECT * FROM mv
UNION ALL SELECT * FROM allnull UNION ALL SELECT * FROM wt
"""


@register("nf5_schema_review", _NF5_SQL)
def nf5_schema_review(spark, sf):
    """Six kinds of schema fault as one findings table (check, table,
    object, n_issues): duplicate keys, orphans, FD violations, multi-valued
    text, all-NULL columns, wrong types against the contract."""
    li, o, c = _t(spark, sf, "lineitem"), _t(spark, sf, "orders"), _t(spark, sf, "customer")
    docs, labels = _t(spark, sf, "documents"), _t(spark, sf, "labels")

    def finding(check, table, obj, df_count):
        return df_count.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                               F.lit(obj).alias("object"), F.col("n").cast("bigint").alias("n_issues"))

    out = [
        finding("missing_key", "lineitem", "l_orderkey,l_linenumber",
                dq.unique(li, ["l_orderkey", "l_linenumber"], "lineitem").select(F.col("failed").alias("n"))),
        finding("missing_key", "orders", "o_orderkey",
                dq.unique(o, ["o_orderkey"], "orders").select(F.col("failed").alias("n"))),
        finding("orphans", "orders", "o_custkey",
                dq.references(o, "o_custkey", c, "c_custkey", "orders").select(F.col("failed").alias("n"))),
        finding("orphans", "labels", "doc_id",
                dq.references(labels, "doc_id", docs, "doc_id", "labels").select(F.col("failed").alias("n"))),
        finding("fd_violation", "customer", "c_nationkey->c_mktsegment",
                nf.check_fd(c, ["c_nationkey"], ["c_mktsegment"]).agg(F.count(F.lit(1)).alias("n"))),
        finding("multi_valued", "documents", "text",
                docs.agg(F.count_if(F.instr("text", "\n") > 0).alias("n"))),
    ]
    prof = dq.profile(labels, ["quality", "toxic"], exact_distinct=False)
    out.append(prof.select(F.lit("all_null").alias("check_name"), F.lit("labels").alias("table_name"),
                           F.col("column_name").alias("object"),
                           (F.col("n_null") == F.col("n_rows")).cast("bigint").alias("n_issues")))
    raw_orders = spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet")
    ct = dq.check_contract(raw_orders, ORDERS_CONTRACT, count_rows=False).filter(F.col("problem") == "type")
    out.append(finding("wrong_type", "orders", "contract", ct.agg(F.count(F.lit(1)).alias("n"))))
    res = out[0]
    for r in out[1:]:
        res = res.unionByName(r)
    return res


@register("ly1_clustered_layout", f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS n,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1
""")
def ly1_clustered_layout(spark, sf):
    """Write lineitem partitioned by ship year and sorted by ship date, then
    read the whole layout back (tests check the pruned plan)."""
    li = _t(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    path = scratch_path(spark, "ly1-lineitem")
    nf.write_clustered(li, path, ["ship_year"], ["l_shipdate", "l_orderkey"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("ship_year").cast("int").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n"), sc.as_double(F.sum(sc.revenue())).alias("revenue"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
