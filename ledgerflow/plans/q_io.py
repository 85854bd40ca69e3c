"""SRC-1..3 and SNK-1..4 registered queries.

Queries that write run into a fresh scratch path under the shared checkpoint
folder and return the table read back; the oracle is the expected end state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import quality as dq
from ..session import scratch_path
from ..sinks import writes as wr
from ..sources.files import flatten_json, payload_keys, read_delimited
from ..sources.tables import load
from .catalog import register


def _t(spark, sf, name):
    return load(spark, sf, name)


@register("src1_load_contract", "SELECT * FROM supplier")
def src1_load_contract(spark, sf):
    return _t(spark, sf, "supplier")


@register("src2_read_delimited", """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS amt,
       CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS VARCHAR) || ',"' || c_name || '",'
            || CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS VARCHAR) || '-' END AS _bad
FROM customer
""")
def src2_read_delimited(spark, sf):
    """Customers exported as a delimited file the way spreadsheets write it:
    quoted names, some quoted amounts, and negative amounts with a trailing
    minus sign, which does not parse as a decimal. Those rows are kept, with
    the amount NULL and the raw line in ``_bad``."""
    c = _t(spark, sf, "customer")
    amt = sc.money(F.abs("c_acctbal")).cast("string")
    field = (F.when(F.col("c_acctbal") < 0, F.concat(amt, F.lit("-")))
             .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit('"'), amt, F.lit('"')))
             .otherwise(amt))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), F.col("c_name"), F.lit('"')), field)
    path = scratch_path(spark, "src2-delimited")
    c.select(line.alias("value")).write.text(path)
    r = read_delimited(spark, path, "id bigint, name string, amt decimal(18,2)")
    return r.select("id", "name", sc.as_double("amt").alias("amt"), "_bad")


@register("src3_flatten_json", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract(props, '$.absent') AS VARCHAR) AS absent
FROM events
""")
def src3_flatten_json(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "event_type", "props")
    return flatten_json(e, "props", "k int, absent string")


# Payloads as several senders write them, the same text in both engines.
_PAYLOAD_SQL = """CASE WHEN event_id % 10 = 9 THEN 'k=' || CAST(event_id AS {text}) WHEN event_type = 'error' THEN '{{"k": "' || CAST(event_id AS {text}) || '"}}'
  WHEN event_type = 'signup' THEN '{{"k": ' || CAST(event_id AS {text}) || ', "ref": "r", "tags": [1]}}' WHEN event_type = 'purchase' THEN '{{"k": ' || CAST(event_id AS {text}) || '.5, "price": 3}}'
  WHEN event_id % 10 = 8 THEN '{{"k": null}}' ELSE props END"""


@register("src3_payload_keys", f"""
WITH p AS (SELECT {_PAYLOAD_SQL.format(text="VARCHAR")} AS p FROM events),
k AS (SELECT p, unnest(CASE WHEN json_valid(p) THEN json_keys(p) ELSE [NULL] END) AS key FROM p),
t AS (SELECT key, CASE WHEN key IS NULL THEN 'malformed' ELSE json_type(p, '$.' || key) END AS t FROM k)
SELECT key, CASE WHEN t IN ('UBIGINT', 'BIGINT') THEN 'integer' WHEN t = 'DOUBLE' THEN 'decimal' WHEN t = 'VARCHAR' THEN 'string' ELSE lower(t) END AS kind, COUNT(*) AS n_rows,
       CASE WHEN key IS NULL THEN 'malformed' WHEN key = 'k' THEN CASE WHEN t IN ('UBIGINT', 'BIGINT', 'NULL') THEN 'ok' ELSE 'conflict' END
            WHEN key = 'price' THEN 'ok' ELSE 'unknown' END AS status
FROM t GROUP BY ALL
""")
def src3_payload_keys(spark, sf):
    """Keys of event payloads against a declared schema: fitting, conflicting,
    unknown and malformed ones."""
    e = _t(spark, sf, "events").select(F.expr(_PAYLOAD_SQL.format(text="STRING")).alias("p"))
    return payload_keys(e, "p", "k int, price double")


@register("snk1_partition_overwrite", """
SELECT strftime(o_orderdate, '%Y-%m') AS ym, COUNT(*) AS n,
       CAST(SUM(CASE WHEN year(o_orderdate) = 1997 THEN 2 * CAST(o_totalprice AS DECIMAL(18,2))
                     ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total
FROM orders GROUP BY 1
""")
def snk1_partition_overwrite(spark, sf):
    """Load all months, then apply a corrected 1997 batch (amounts doubled)
    twice. Only the 1997 partitions change; the rerun changes nothing."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", sc.money("o_totalprice").alias("amount"),
                                       F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
    path = scratch_path(spark, "snk1-orders")
    wr.write_partitions(o, path, ["ym"])
    fix = o.filter(F.year("o_orderdate") == 1997).withColumn("amount", (F.col("amount") * 2).cast(sc.MONEY))
    wr.write_partitions(fix, path, ["ym"])
    wr.write_partitions(fix, path, ["ym"])
    back = spark.read.option("basePath", path).schema("o_orderkey bigint, o_orderdate timestamp_ntz, "
                                                      "amount decimal(18,2), ym string").parquet(path)
    return back.groupBy("ym").agg(F.count(F.lit(1)).alias("n"), sc.as_double(F.sum("amount")).alias("total"))


@register("snk2_upsert", """
SELECT c_custkey, c_name,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       c_mktsegment, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 2 ELSE 1 END AS version
FROM customer WHERE c_mktsegment <> 'MACHINERY' OR c_acctbal >= 0
""")
def snk2_upsert(spark, sf):
    """Snapshot of every customer outside AUTOMOBILE or under 9000, then a
    batch re-issuing every AUTOMOBILE customer (balance + 1, version 2) and
    deleting MACHINERY customers in debt, applied twice: updates, inserts
    and keyed deletes in one pass; the second application is a no-op."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    table = scratch_path(spark, "snk2-customers")
    auto, debt = F.col("c_mktsegment") == "AUTOMOBILE", (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)
    wr.upsert(spark, table, c.filter(~auto | (F.col("c_acctbal") < 9000)).withColumn("version", F.lit(1)),
              ["c_custkey"], ["version"])
    batch = c.filter(auto | debt).withColumn("c_acctbal", F.when(auto, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))) \
             .withColumn("version", F.lit(2)).withColumn("gone", debt)
    for _ in range(2):
        wr.upsert(spark, table, batch, ["c_custkey"], ["version"], deleted="gone")
    return wr.read_current(spark, table)


EVENT_RULES_SQL = {
    "in_range:value": "COALESCE(value < 0 OR value > 300, FALSE)",
    "pattern:props": """COALESCE(NOT regexp_matches(props, '^\\{"k": [0-9]+\\}$'), FALSE)""",
    "not_null:user_id": "user_id IS NULL",
}


def event_rules():
    return [dq.in_range("value", 0, 300), dq.matches("props", r'^\{"k": [0-9]+\}$'), dq.not_null("user_id", False)]


_FAILED_SQL = "concat_ws(';', " + ", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in EVENT_RULES_SQL.items()) + ")"
_ANY_BAD_SQL = " OR ".join(f"({v})" for v in EVENT_RULES_SQL.values())


@register("snk3_dead_letter", f"""
SELECT event_id, CASE WHEN {_ANY_BAD_SQL} THEN 'dead_letter' ELSE 'target' END AS dest,
       CASE WHEN {_ANY_BAD_SQL} THEN {_FAILED_SQL} END AS failed_rules,
       CASE WHEN {_ANY_BAD_SQL} THEN '007' END AS batch_id
FROM events
""")
def snk3_dead_letter(spark, sf):
    e = _t(spark, sf, "events")
    base = scratch_path(spark, "snk3")
    wr.audited_write(spark, "events_load", "007", e, event_rules(), f"{base}/data", f"{base}/audit")
    g = wr.read_written(spark, f"{base}/data", wr.TARGET).select(
        "event_id", F.lit("target").alias("dest"), F.lit(None).cast("string").alias("failed_rules"),
        F.lit(None).cast("string").alias("batch_id"))
    b = wr.read_written(spark, f"{base}/data", wr.DEAD_LETTER).select(
        "event_id", F.lit("dead_letter").alias("dest"), F.concat_ws(";", "failed_rules").alias("failed_rules"),
        "batch_id")
    return g.unionByName(b)


@register("snk4_audit", f"""
SELECT 'events_load' AS step, CASE WHEN user_id % 2 = 0 THEN '007' ELSE '7' END AS batch_id, CAST(COUNT(*) AS BIGINT) AS rows_in,
       CAST(count_if(NOT ({_ANY_BAD_SQL})) AS BIGINT) AS rows_out,
       CAST(count_if({_ANY_BAD_SQL}) AS BIGINT) AS rows_rejected, 'ok' AS status,
       CAST(count_if(NOT ({_ANY_BAD_SQL})) AS BIGINT) AS in_target, CAST(count_if({_ANY_BAD_SQL}) AS BIGINT) AS in_dead_letter
FROM events GROUP BY 2
""")
def snk4_audit(spark, sf):
    """Events loaded in two batches; what the audit says of each batch next
    to what the table holds of it afterwards."""
    e = _t(spark, sf, "events")
    base = scratch_path(spark, "snk4")
    for k, batch in enumerate(("007", "7")):
        wr.audited_write(spark, "events_load", batch, e.filter(F.col("user_id") % 2 == k), event_rules(), f"{base}/data", f"{base}/audit")
    held = wr.read_batches(spark, f"{base}/data").groupBy("batch_id").agg(
        F.count_if(F.col("dest") == wr.TARGET).alias("in_target"), F.count_if(F.col("dest") == wr.DEAD_LETTER).alias("in_dead_letter"))
    audit = spark.read.parquet(f"{base}/audit").select("step", "batch_id", "rows_in", "rows_out", "rows_rejected", "status")
    return audit.join(held, "batch_id")
