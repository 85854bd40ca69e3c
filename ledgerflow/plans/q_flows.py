"""Flows over several operators, as one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import business as bz
from ..operators import dedup as dd
from ..operators import model as nf
from ..operators import quality as dq
from ..session import keep
from ..sources.tables import load
from .catalog import register
from .q_business import REV
from .q_dedup import LEV_K, _pairs_sql
from .q_quality import _DQ10_SQL

_ORDER_COLS = "l_orderkey, o_custkey, o_orderdate, o_orderstatus"


@register("flow_customer_platform", f"""
WITH RECURSIVE {_pairs_sql(LEV_K)},
edges AS (SELECT id_a AS u, id_b AS v FROM pairs UNION SELECT id_b, id_a FROM pairs),
reach(node, cluster) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.v, r.cluster FROM reach r JOIN edges e ON e.u = r.node),
clusters AS (SELECT node, min(cluster) AS cluster FROM reach GROUP BY node),
golden AS (SELECT cluster, COUNT(*) AS n, max(n_chars) AS chars FROM clusters JOIN documents ON doc_id = node GROUP BY cluster),
wide AS (SELECT l_orderkey, o_custkey, o_orderdate, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
alerts AS ({_DQ10_SQL})
SELECT 'records' AS measure, CAST(COUNT(*) AS DOUBLE) AS value FROM documents
UNION ALL SELECT 'null_or_repeated_ids', CAST(COUNT(*) - COUNT(DISTINCT doc_id) AS DOUBLE) FROM documents
UNION ALL SELECT 'golden_records', CAST(COUNT(*) AS DOUBLE) FROM golden
UNION ALL SELECT 'records_in_golden', CAST(SUM(n) AS DOUBLE) FROM golden
UNION ALL SELECT 'largest_cluster', CAST(max(n) AS DOUBLE) FROM golden
UNION ALL SELECT 'golden_chars', CAST(SUM(chars) AS DOUBLE) FROM golden
UNION ALL SELECT 'order_rows', CAST((SELECT COUNT(*) FROM (SELECT DISTINCT {_ORDER_COLS} FROM wide)) AS DOUBLE)
UNION ALL SELECT 'order_key_faults', CAST(COUNT(*) AS DOUBLE) FROM (SELECT l_orderkey FROM (SELECT DISTINCT {_ORDER_COLS} FROM wide) GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'revenue', CAST(SUM({REV}) AS DOUBLE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'orders_sold', CAST(COUNT(DISTINCT l_orderkey) AS DOUBLE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'alert_days', CAST(count_if(alert) AS DOUBLE) FROM alerts
""")
def flow_customer_platform(spark, sf):
    """A customer platform end to end: records profiled, copies and near
    copies clustered into golden records, sales rows split and their key
    proven, sales rolled up, the error rate monitored; one row per measure."""
    t = {n: load(spark, sf, n) for n in ("documents", "lineitem", "orders", "customer", "nation", "region", "events")}
    d = t["documents"]
    profile = keep(dq.profile(d, ["doc_id"]), "flow-profile")
    labels = dd.components(dd.lev_pairs(d, "doc_id", dd.normalize_key("text"), LEV_K).select(F.col("id_a").alias("u"), F.col("id_b").alias("v")),
                           d.select(F.col("doc_id").alias("node")))
    members = d.select("doc_id", "n_chars").join(labels.withColumnRenamed("node", "doc_id"), "doc_id")
    golden = keep(dd.survivor(members, "cluster", {"n": F.count(F.lit(1)), "chars": F.max("n_chars")}), "flow-golden")
    o, li = t["orders"], t["lineitem"]
    wide = li.join(o, li.l_orderkey == o.o_orderkey).select(*_ORDER_COLS.split(", "))
    proof = keep(nf.lossless_by_keys(nf.decompose(wide, {"line": ["l_orderkey"], "order": _ORDER_COLS.split(", ")}), [("line", []), ("order", ["l_orderkey"])]), "flow-model")
    cube = bz.sales_cube(li, o, t["customer"], t["nation"], t["region"]).filter("level = 3")
    daily = t["events"].groupBy(F.to_date("ts").alias("day")).agg(F.round(F.count_if(F.col("event_type") == "error") / F.count(F.lit(1)), 6).alias("rate"))
    trend = dq.dq_trend(daily, "day", "rate", lookback=7, factor=1.5)
    late = F.coalesce(F.col("rate") > F.round("trailing_mean", 6) * 1.5, F.lit(False))

    def measures(df, **by):
        one = df.agg(*[c.cast("double").alias(n) for n, c in by.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in by])).alias("x")).select("x.*")
    out = measures(profile, records=F.max("n_rows"), null_or_repeated_ids=F.max(F.col("n_rows") - F.col("n_distinct")))
    for more in (measures(golden, golden_records=F.count(F.lit(1)), records_in_golden=F.sum("n"), largest_cluster=F.max("n"), golden_chars=F.sum("chars")),
                 measures(proof, order_rows=F.max("n_rows"), order_key_faults=F.max(F.col("repeated_keys") + F.col("null_keys"))),
                 measures(cube, revenue=F.sum(F.col("revenue").cast("decimal(38,4)")), orders_sold=F.sum("orders")),
                 measures(trend, alert_days=F.count_if(late))):
        out = out.unionByName(more)
    return out
