"""End-to-end flows on sf0.001.

Flow B, ETL batch: delimited export -> typed parse with reasons -> row rules
-> gate -> dead-letter split -> idempotent upsert -> audit row; the whole
batch runs twice and the second run changes nothing.

Flow C, customer data platform: load under contract -> profile -> exact and
near-duplicate documents -> components -> survivor per cluster -> 3NF split
with lossless proof -> sales rollup -> daily DQ trend.
"""

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import scalar as sc
from ledgerflow.operators import business as bz
from ledgerflow.operators import dedup as dd
from ledgerflow.operators import model as nf
from ledgerflow.operators import quality as dq
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writes as wr
from ledgerflow.sources.files import read_delimited
from ledgerflow.sources.tables import load
from tests.conftest import SF_SMALL


def _export_customers(spark, path):
    """Customers as text lines; negative balances get a trailing minus sign
    (a spreadsheet habit) that does not parse as a number."""
    c = load(spark, SF_SMALL, "customer")
    amt = F.format_number(F.abs("c_acctbal"), 2)
    amt = F.regexp_replace(amt, ",", "")
    field = F.when(F.col("c_acctbal") < 0, F.concat(amt, F.lit("-"))).otherwise(amt)
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"), field)
    c.select(line.alias("value")).write.text(path)
    return c


def _batch(spark, src, batch_id, base):
    raw = read_delimited(spark, src, "id bigint, name string, segment string, amt_text string", sep="|")
    amt, reason = sc.parse_typed("amt_text", "decimal(18,2)")
    typed = raw.select("id", "name", "segment", amt.alias("amt"), reason.alias("parse_error"))
    rules = [dq.not_null("amt", False), dq.accepted("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE",
                                                                "HOUSEHOLD", "MACHINERY"])]
    results = dq.evaluate(typed, rules, "customer_feed")
    gated = dq.gate(results, {"not_null": 0.5, "accepted_values": 0.0})
    if not dq.gate_passes(gated):
        return None, gated
    audit = wr.audited_write(spark, "customer_feed", batch_id, typed, rules, f"{base}/data", f"{base}/audit")
    wr.upsert(spark, f"{base}/customers", wr.read_written(spark, f"{base}/data", wr.TARGET), ["id"], ["amt"])
    return audit, gated


def test_flow_b_etl_batch_twice(spark):
    base = scratch_path(spark, "flow-b")
    src = f"{base}/in"
    c = _export_customers(spark, src)
    n_in, n_neg = c.count(), c.filter(F.col("c_acctbal") < 0).count()
    a1, gated = _batch(spark, src, "b1", base)
    assert gated.first().decision == "pass"
    assert (a1["rows_in"], a1["rows_out"], a1["rows_rejected"]) == (n_in, n_in - n_neg, n_neg)
    snap1 = wr.read_current(spark, f"{base}/customers")
    a2, _ = _batch(spark, src, "b1", base)
    snap2 = wr.read_current(spark, f"{base}/customers")
    assert a2["rows_out"] == a1["rows_out"]
    assert snap1.count() == snap2.count() == n_in - n_neg
    assert snap1.exceptAll(snap2).count() == 0 and snap2.exceptAll(snap1).count() == 0
    # Dead letters carry the reason; the rerun replaced its batch partition.
    bad = wr.read_written(spark, f"{base}/data", wr.DEAD_LETTER)
    assert bad.count() == n_neg
    assert bad.filter(F.col("parse_error").startswith("not a decimal")).count() == n_neg
    assert bad.filter(F.array_contains("failed_rules", "not_null:amt")).count() == n_neg
    assert spark.read.parquet(f"{base}/audit").count() == 2
    # A strict gate blocks before anything is written.
    raw = read_delimited(spark, src, "id bigint, name string, segment string, amt_text string", sep="|")
    amt, _ = sc.parse_typed("amt_text", "decimal(18,2)")
    res = dq.evaluate(raw.select(amt.alias("amt")), [dq.not_null("amt", False)], "customer_feed")
    assert not dq.gate_passes(dq.gate(res, 0.0))


@pytest.fixture(scope="module")
def docs(spark):
    return load(spark, SF_SMALL, "documents")


def test_flow_c_customer_platform(spark, docs):
    prof = {r.column_name: r for r in dq.profile(docs, ["doc_id", "text"]).collect()}
    n_docs = prof["doc_id"].n_rows
    assert prof["doc_id"].n_distinct == n_docs and prof["doc_id"].n_null == 0

    norm = docs.select("doc_id", dd.normalize_key("text").alias("t"))
    copies = dd.exact_dups(norm, "doc_id", F.col("t"))
    pairs = dd.lev_pairs(norm, "doc_id", F.col("t"), 12)
    edges = pairs.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).unionByName(
        copies.select(F.col("doc_id").alias("u"), F.col("canonical_id").alias("v")))
    lab = dd.components(edges, docs.select(F.col("doc_id").alias("node")))
    assert lab.count() == n_docs
    # Every exact copy and every near pair lands in one cluster.
    lab_a = lab.select(F.col("node").alias("id_a"), F.col("cluster").alias("ca"))
    lab_b = lab.select(F.col("node").alias("id_b"), F.col("cluster").alias("cb"))
    assert pairs.join(lab_a, "id_a").join(lab_b, "id_b").filter(F.col("ca") != F.col("cb")).count() == 0
    same = copies.join(lab.withColumnRenamed("node", "doc_id"), "doc_id") \
                 .groupBy("canonical_id").agg(F.countDistinct("cluster").alias("n"))
    assert same.filter(F.col("n") > 1).count() == 0
    # Cluster label is the smallest member id.
    assert lab.filter(F.col("cluster") > F.col("node")).count() == 0

    x = docs.join(lab.withColumnRenamed("node", "doc_id"), "doc_id")
    rank = F.struct(F.col("n_chars"), -F.col("doc_id"))
    surv = dd.survivor(x, "cluster", {"n_docs": F.count(F.lit(1)), "survivor_id": F.max_by("doc_id", rank)})
    assert surv.count() == lab.select("cluster").distinct().count()
    assert surv.agg(F.sum("n_docs")).first()[0] == n_docs


def test_flow_c_model_sales_and_monitor(spark):
    li, o, c = (load(spark, SF_SMALL, t) for t in ("lineitem", "orders", "customer"))
    wide = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
            .select("l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderdate", "c_name",
                    "c_mktsegment")).distinct()
    spec = {"line": ["l_orderkey", "l_linenumber", "l_quantity"], "order": ["l_orderkey", "o_custkey", "o_orderdate"],
            "customer": ["o_custkey", "c_name", "c_mktsegment"]}
    parts = nf.decompose(wide, spec)
    lost = nf.lossless_check(wide, parts, [("line", []), ("order", ["l_orderkey"]), ("customer", ["o_custkey"])])
    assert lost.count() == 0
    assert nf.check_fd(parts["order"], ["l_orderkey"], ["o_custkey", "o_orderdate"]).count() == 0

    n, r = load(spark, SF_SMALL, "nation"), load(spark, SF_SMALL, "region")
    cube = bz.sales_cube(li, o, c, n, r)
    total = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey) \
              .agg(F.sum(sc.revenue()).cast("double").alias("rev"), F.countDistinct("l_orderkey").alias("n"))
    t = total.first()
    top = cube.filter(F.col("level") == 3).agg(F.sum("revenue").alias("rev"), F.sum("orders").alias("n")).first()
    assert abs(top.rev - t.rev) < 1e-6 * max(1.0, t.rev) and top.n == t.n

    e = load(spark, SF_SMALL, "events")
    rule = dq.in_range("value", 0, 300)
    daily = e.groupBy(F.to_date("ts").alias("day")).agg(
        (F.count_if(rule.fails) / F.count(F.lit(1))).alias("rate"))
    alerts = dq.dq_trend(daily, "day", "rate")
    assert alerts.count() == daily.count()
    first_day = daily.agg(F.min("day")).first()[0]
    assert alerts.filter(F.col("day") == first_day).first().trailing_mean is None
