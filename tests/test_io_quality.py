"""Sources, sinks, data quality and streaming: hand-made inputs with known
answers, and every writer run twice."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import scalar as sc
from ledgerflow.operators import business as bz
from ledgerflow.operators import joins as jn
from ledgerflow.operators import quality as dq
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writes as wr
from ledgerflow.sources import tables
from ledgerflow.sources.files import flatten_json, payload_keys, read_delimited
from ledgerflow.sources.tables import SCHEMAS, SchemaContractError, load
from ledgerflow.streaming import streams as st
from tests.conftest import SF_SMALL


def test_contract_violation_names_the_column(spark):
    path = scratch_path(spark, "bad-orders")
    o = load(spark, SF_SMALL, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    o.write.parquet(f"{path}/orders.parquet")
    with pytest.raises(SchemaContractError, match="o_orderdate"):
        load(spark, path, "orders")


def test_read_delimited_keeps_malformed_rows(spark):
    d = tempfile.mkdtemp(prefix="lf-csv-")
    with open(f"{d}/a.csv", "w") as f:
        f.write('1,10.50\n2,abc\n3\n4,"7.25"\n')
    r = {x.id: (x.amt, x._bad) for x in read_delimited(spark, d, "id int, amt decimal(18,2)").collect()}
    assert float(r[1][0]) == 10.5 and r[1][1] is None
    assert r[2][0] is None and r[2][1] == "2,abc"          # bad number
    assert r[3][0] is None and r[3][1] == "3"              # short row
    assert float(r[4][0]) == 7.25 and r[4][1] is None      # quoted number


def test_flatten_json_absent_key_and_garbage(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, '{"j": 1}'), (3, "not json")], "id int, p string")
    got = {r.id: r.k for r in flatten_json(df, "p", "k int").collect()}
    assert got == {1: 3, 2: None, 3: None}


def test_payload_keys_report_unknown_and_conflicting_ones(spark):
    rows = ['{"k": 1, "z": "a"}', '{"k": "x"}', "bad", "[1]", '{"k": 1.5, "n": null, "o": {"a": 1}}', None, "{}", '{"K": true}']
    df = spark.createDataFrame([(r,) for r in rows], "p string")
    got = {(r.key, r.kind): (r.n_rows, r.status) for r in payload_keys(df, "p", "k int, o struct<a:int>, n double").collect()}
    assert got == {("k", "integer"): (1, "ok"), ("k", "string"): (1, "conflict"), ("k", "decimal"): (1, "conflict"), ("z", "string"): (1, "unknown"),
                   ("n", "null"): (1, "ok"), ("o", "object"): (1, "ok"), ("K", "boolean"): (1, "unknown"), (None, "malformed"): (2, "malformed")}


def test_safe_div_and_get_or(spark):
    df = spark.createDataFrame([(1.0, 0.0, '{"a": 1}'), (1.0, None, None), (6.0, 3.0, "{}")], "a double, b double, j string")
    r = df.select(sc.safe_div("a", "b").alias("q"), sc.get_or("j", "a", "9").alias("v")).collect()
    assert [(x.q, x.v) for x in r] == [(None, "1"), (None, "9"), (2.0, "9")]


def test_parse_typed_reason(spark):
    df = spark.createDataFrame([("12",), ("x1",), (None,)], "s string")
    v, why = sc.parse_typed(F.col("s"), "int")
    r = df.select(v.alias("v"), why.alias("why")).collect()
    assert [(x.v, x.why) for x in r] == [(12, None), (None, "not a int: x1"), (None, None)]


def test_partition_overwrite_is_idempotent(spark):
    o = load(spark, SF_SMALL, "orders").withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    path = scratch_path(spark, "t-snk1")
    wr.write_partitions(o, path, ["ym"])
    n1 = spark.read.parquet(path).count()
    wr.write_partitions(o, path, ["ym"])
    assert spark.read.parquet(path).count() == n1 == o.count()
    one_month = o.filter(F.col("ym") == "1996-03")
    wr.write_partitions(one_month.withColumn("o_totalprice", F.lit(0.0)), path, ["ym"])
    back = spark.read.parquet(path)
    assert back.count() == n1
    assert back.filter(F.col("o_totalprice") == 0.0).count() == one_month.count()


def test_upsert_twice_changes_nothing(spark):
    c = load(spark, SF_SMALL, "customer").withColumn("version", F.lit(1))
    t = scratch_path(spark, "t-snk2")
    wr.upsert(spark, t, c.filter(F.col("c_custkey") < 100), ["c_custkey"], ["version"])
    batch = c.filter(F.col("c_custkey") >= 90).withColumn("version", F.lit(2))
    wr.upsert(spark, t, batch, ["c_custkey"], ["version"])
    first = sorted(map(tuple, wr.read_current(spark, t).collect()))
    wr.upsert(spark, t, batch, ["c_custkey"], ["version"])
    second = sorted(map(tuple, wr.read_current(spark, t).collect()))
    assert first == second and len(first) == c.count()


def test_upsert_survives_a_crash_before_the_commit(spark):
    c = load(spark, SF_SMALL, "customer").select("c_custkey", F.lit(1).alias("version"))
    t = scratch_path(spark, "t-snk2-crash")
    assert wr.current_snapshot(spark, t) is None
    snap = wr.upsert(spark, t, c, ["c_custkey"], ["version"])
    # A later run died after writing its snapshot, before committing it.
    c.withColumn("version", F.lit(9)).write.parquet(f"{t}/_staged-orphan")
    assert wr.current_snapshot(spark, t) == snap
    assert wr.read_current(spark, t).filter(F.col("version") == 9).count() == 0
    # The next run starts from the committed snapshot.
    batch = c.filter(F.col("c_custkey") < 5).withColumn("version", F.lit(2))
    wr.upsert(spark, t, batch, ["c_custkey"], ["version"])
    n = batch.count()
    assert wr.read_current(spark, t).groupBy("version").count().orderBy("version").collect() == [
        (1, c.count() - n), (2, n)]


def test_dead_letter_split_is_complete(spark):
    e = load(spark, SF_SMALL, "events")
    rules = [dq.in_range("value", 0, 100)]
    good, bad = wr.split_dead_letter(e, rules, "b7")
    assert good.count() + bad.count() == e.count()
    assert bad.filter(F.col("value") <= 100).count() == 0
    assert {r.batch_id for r in bad.select("batch_id").distinct().collect()} <= {"b7"}


def test_upsert_ignores_clocks_and_deletes_by_key(spark, monkeypatch):
    """The second writer's clock is an hour behind; its batch still counts."""
    import time
    rows = lambda *r: spark.createDataFrame(r, "k int, v string, version int")
    t = scratch_path(spark, "t-snk2-clock")
    wr.upsert(spark, t, rows((1, "a", 1), (2, "b", 1), (3, "c", 1)), ["k"], ["version"])
    now, now_ns = time.time(), time.time_ns()
    monkeypatch.setattr(time, "time", lambda: now - 3600)
    monkeypatch.setattr(time, "time_ns", lambda: now_ns - 3600 * 10**9)
    batch = rows((2, "x", 2), (3, "y", 2), (4, "z", 2)).withColumn("gone", F.col("k") == 3)
    for _ in range(2):
        wr.upsert(spark, t, batch, ["k"], ["version"], deleted="gone")
        got = sorted(map(tuple, wr.read_current(spark, t).collect()))
        assert got == [(1, "a", 1), (2, "x", 2), (4, "z", 2)]


def test_concurrent_upserts_lose_no_batch(spark):
    """Four writers start from the same version; a writer that finds its
    version taken reads again and retries."""
    from concurrent.futures import ThreadPoolExecutor
    t = scratch_path(spark, "t-snk2-race")
    schema = "k int, v int"
    wr.upsert(spark, t, spark.createDataFrame([(0, 0)], schema), ["k"], ["v"])
    batches = [spark.createDataFrame([(k, 1), (0, k)], schema) for k in range(1, 5)]
    with ThreadPoolExecutor(4) as pool:
        snaps = list(pool.map(lambda b: wr.upsert(spark, t, b, ["k"], ["v"]), batches))
    assert len(set(snaps)) == 4 and wr.current_version(spark, t) == 5
    assert sorted(map(tuple, wr.read_current(spark, t).collect())) == [(0, 4), (1, 1), (2, 1), (3, 1), (4, 1)]


def test_audit_appends_one_row_per_run_and_batches_stay(spark):
    e = load(spark, SF_SMALL, "events")
    rules = [dq.in_range("value", 0, 100)]
    base = scratch_path(spark, "t-audit")
    for batch, part in (("007", e.filter("event_id < 400")), ("7", e.filter("event_id >= 400")), ("007", e.filter("event_id < 400"))):
        row = wr.audited_write(spark, "load", batch, part, rules, f"{base}/data", f"{base}/audit")
        assert row["rows_in"] == part.count() == row["rows_out"] + row["rows_rejected"] and row["status"] == "ok"
    a = spark.read.parquet(f"{base}/audit").collect()
    assert len(a) == 3 and {r.status for r in a} == {"ok"}
    good, bad = wr.read_written(spark, f"{base}/data", wr.TARGET), wr.read_written(spark, f"{base}/data", wr.DEAD_LETTER)
    assert good.count() + bad.count() == e.count() and bad.filter("value <= 100").count() == 0
    assert {r.batch_id for r in good.select("batch_id").distinct().collect()} == {"007", "7"}
    # The batch comes again, corrected: its dead letters go, the other batch's stay.
    n2 = bad.filter("batch_id = '7'").count()
    wr.audited_write(spark, "load", "007", e.filter("event_id < 400 AND value <= 100"), rules, f"{base}/data", f"{base}/audit")
    again = wr.read_written(spark, f"{base}/data", wr.DEAD_LETTER)
    assert again.count() == n2 and again.filter("batch_id = '007'").count() == 0


def test_gated_write_stores_nothing_when_blocked(spark):
    e = load(spark, SF_SMALL, "events")
    base = scratch_path(spark, "t-gated")
    row = wr.gated_write(spark, "load", "b1", e, [dq.in_range("value", 0, 100)], 0.0, f"{base}/data", f"{base}/audit")
    assert row["decision"] == "block" and spark.read.parquet(f"{base}/audit").first().status == "blocked"
    assert not wr._fs(spark, base).exists(wr._jpath(spark, f"{base}/data"))


def test_malformed_lines_show_when_only_that_column_is_read(spark):
    d = tempfile.mkdtemp(prefix="lf-csv-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("1,10.50\n2,abc\n3\n")
    df = read_delimited(spark, d, "id int, amt decimal(18,2)")
    assert {(r.id, r._bad) for r in df.select("id", "_bad").collect()} == {(1, None), (2, "2,abc"), (3, "3")}
    assert df.filter(F.col("_bad").isNotNull()).count() == 2 and df.select("_bad").distinct().count() == 3


def test_get_or_kinds_and_parse_typed_formats(spark):
    df = spark.sql("""SELECT '{"a": 1}' AS j, map('a', 2) AS m, named_struct('a', cast(NULL AS int)) AS s, '31/12/2024' AS d, '31/12/2024 23:10' AS t
                      UNION ALL SELECT NULL, NULL, NULL, '2024-12-31', NULL""")
    r = df.select(sc.get_or("j", "a", "9").alias("j"), sc.get_or("m", "a", 9, "map").alias("m"), sc.get_or("m", "b", 9, "map").alias("n"),
                  sc.get_or("s", "a", 9, "struct").alias("s")).collect()
    assert [tuple(x) for x in r] == [("1", 2, 9, 9), ("9", 9, 9, 9)]
    v, why = sc.parse_typed("d", "date", "dd/MM/yyyy")
    t, _ = sc.parse_typed("t", "timestamp_ntz", "dd/MM/yyyy HH:mm")
    x = df.select(v.alias("v"), why.alias("why"), t.alias("t"))
    assert dict(x.dtypes)["v"] == "date" and dict(x.dtypes)["t"] == "timestamp_ntz"
    assert [(str(r.v), r.why, str(r.t)) for r in x.collect()] == [("2024-12-31", None, "2024-12-31 23:10:00"),
                                                                 ("None", "not a date: 2024-12-31", "None")]


def test_revenue_units_round_as_money(spark):
    df = spark.createDataFrame([(1.005, 0.0), (10.0, 0.035), (2.675, 0.1), (-3.335, 0.04)], "p double, d double")
    r = df.select(sc.revenue("p", "d").cast("double").alias("a"), sc.as_double(sc.units_to_money(sc.revenue_units("p", "d"))).alias("b")).collect()
    assert all(x.a == x.b for x in r)


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for values in ([], [2, 2], [2, None]):
        right = spark.createDataFrame([(v,) for v in values], "b int")
        left.createOrReplaceTempView("l_in")
        right.createOrReplaceTempView("r_in")
        want = spark.sql("SELECT a FROM l_in WHERE a NOT IN (SELECT b FROM r_in)").collect()
        assert sorted(jn.not_in(left, "a", right, "b").collect(), key=str) == sorted(want, key=str)
    plan = jn.not_in(left, "a", spark.range(5).select(F.col("id").cast("int").alias("b")), "b")
    assert "BroadcastExchange" not in plan.hint("merge")._jdf.queryExecution().optimizedPlan().toString()


def _arrivals(spark, base):
    return sorted((r.event_id, r.arrival) for r in st.read_deduped(spark, f"{base}/out", SCHEMAS["events"]).collect())


@pytest.mark.parametrize("remember", ["30 days", None])
def test_each_event_once_and_late_ones_tagged(spark, remember):
    e = load(spark, SF_SMALL, "events").filter("event_id < 300")
    base = scratch_path(spark, "t-st3")
    run = lambda: st.dedup_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", SCHEMAS["events"], ["event_id"], "ts", "1 day", remember)
    e.filter("event_id not in (3, 4, 5)").write.mode("append").parquet(f"{base}/in")
    run()
    assert _arrivals(spark, base) == [(i, "on_time") for i in range(300) if i not in (3, 4, 5)]
    # Old events for the first time, in two files, among re-sent old and new ones.
    e.filter("event_id in (3, 4, 7, 299)").write.mode("append").parquet(f"{base}/in")
    e.filter("event_id in (4, 5, 9)").write.mode("append").parquet(f"{base}/in")
    run()
    run()
    want = [(i, "late" if i in (3, 4, 5) else "on_time") for i in range(300)]
    assert _arrivals(spark, base) == want


def test_a_file_that_lands_during_a_run_gives_each_event_once(spark, monkeypatch):
    e = load(spark, SF_SMALL, "events").filter("event_id < 200")
    base = scratch_path(spark, "t-st3-race")
    run = lambda: st.dedup_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", SCHEMAS["events"], ["event_id"], "ts", "1 day", max_files_per_trigger=1)
    e.filter("event_id > 100").write.mode("append").parquet(f"{base}/in")
    landed = []
    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet

    def land(self, path, *a, **k):
        write(self, path, *a, **k)
        if "/out/" in path and not landed:  # after the batch is stored, before it is committed
            landed.append(path)
            write(e.filter("event_id between 2 and 120").write.mode("append"), f"{base}/in")
    monkeypatch.setattr(DataFrameWriter, "parquet", land)
    run()
    run()
    e.write.mode("append").parquet(f"{base}/in")
    run()
    got = _arrivals(spark, base)
    assert landed and [i for i, _ in got] == list(range(200))


def test_a_batch_that_is_run_again_stores_its_rows_once(spark, monkeypatch):
    e = load(spark, SF_SMALL, "events").filter("event_id < 50")
    base = scratch_path(spark, "t-st3-retry")
    run = lambda: st.dedup_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", SCHEMAS["events"], ["event_id"], "ts")
    e.write.mode("append").parquet(f"{base}/in")
    from pyspark.sql.readwriter import DataFrameWriter
    write = DataFrameWriter.parquet

    def fail(self, path, *a, **k):
        if "-clock" in path:
            raise OSError("lost")
        write(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", fail)
    with pytest.raises(Exception):
        run()
    monkeypatch.undo()
    run()
    run()
    assert _arrivals(spark, base) == [(i, "on_time") for i in range(50)]


def test_cleaning(spark):
    from ledgerflow.operators import cleaning as cl
    df = spark.createDataFrame([(1, "a", 2.0, " New  York"), (2, "a", None, "NY"), (3, "a", 4.0, "boston"), (4, "b", None, None), (5, None, None, "new york"), (6, None, 8.0, "x")],
                               "id int, g string, v double, city string")
    r = cl.fill_by_group(df, "v", ["g"], F.avg("v"), "filled").orderBy("id").collect()
    assert [(x.v, x.filled) for x in r] == [(2.0, False), (3.0, True), (4.0, False), (None, False), (8.0, True), (8.0, False)]
    names = {"new york": "New York", "ny": "New York", "Boston": "Boston"}
    assert [x.city for x in cl.standardise(df, "city", names).orderBy("id").collect()] == ["New York", "New York", "Boston", None, "New York", "x"]
    assert [x.city for x in cl.standardise(df, "city", names, "Other").orderBy("id").collect()][-1] == "Other"
    assert [x.v for x in cl.fill_missing(df, {"v": F.col("id") * 1.0}).orderBy("id").collect()] == [2.0, 2.0, 4.0, 4.0, 5.0, 8.0]


@pytest.fixture(scope="module")
def faulty(spark):
    rows = [(1, "a", 5, 10), (2, None, 5, 20), (3, " ", 7, -1), (3, "d", 9, 500), (5, "e", None, 30), (None, "f", 5, 40)]
    return spark.createDataFrame(rows, "id int, name string, fk int, amount int")


def test_planted_faults_exact_counts(spark, faulty):
    parent = spark.createDataFrame([(5,), (7,)], "pk int")
    res = {(r.rule, r.column_name): r.failed for r in dq.evaluate(
        faulty, [dq.not_null("name"), dq.not_null("id"), dq.in_range("amount", 0, 100)], "t").collect()}
    assert res == {("not_null", "name"): 2, ("not_null", "id"): 1, ("in_range", "amount"): 2}
    assert dq.unique(faulty, ["id"], "t").first().failed == 1
    assert dq.references(faulty, "fk", parent, "pk", "t").first().failed == 1  # fk 9; NULL exempt
    assert jn.check_grain(faulty, ["id"]).count() == 1


def test_gate_blocks_and_passes(spark, faulty):
    res = dq.evaluate(faulty, [dq.not_null("name")], "t")
    assert not dq.gate_passes(dq.gate(res, 0.0))
    assert dq.gate(res, 0.0).first().decision == "block"
    assert dq.gate(res, 0.5).first().decision == "pass"


def test_contract_report(spark):
    o = spark.read.parquet(tables.table_path(SF_SMALL, "orders"))
    assert dq.check_contract(o, SCHEMAS["orders"]).count() == 0
    from ledgerflow.plans.q_quality import ORDERS_CONTRACT
    got = {(r.column_name, r.problem, r.violating_rows) for r in dq.check_contract(o, ORDERS_CONTRACT).collect()}
    n = o.count()
    assert got == {("o_orderdate", "type", 0), ("o_clerk", "missing", n), ("o_orderpriority", "unexpected", n),
                   ("o_orderkey", "nullable", 0), ("o_custkey", "nullable", 0)}
    # Planted: a NULL key, a timestamp that is not a whole day, a text date.
    bad = o.limit(3).withColumn("i", F.monotonically_increasing_id()).select(
        F.when(F.col("i") == 0, None).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(F.col("i") == 1, F.col("o_orderdate") + F.expr("INTERVAL 3 HOURS"))
         .otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(F.col("i") == 2, F.lit("13/45/1999")).otherwise(F.lit("1999-01-02")).alias("d"))
    want = T.StructType([T.StructField("o_orderkey", T.LongType(), False),
                         T.StructField("o_orderdate", T.DateType()), T.StructField("d", T.DateType())])
    got = {(r.column_name, r.problem): r.violating_rows for r in dq.check_contract(bad, want).collect()}
    assert got == {("o_orderkey", "nullable"): 1, ("o_orderdate", "type"): 1, ("d", "type"): 1}


def test_fanout_predicts_join_size(spark):
    o = load(spark, SF_SMALL, "orders").select(F.col("o_orderkey").alias("k"))
    li = load(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("k"))
    rep = jn.fanout(o, li, "k").first()
    assert rep.joined_rows == o.join(li, "k").count() and rep.relation == "1:N"


def test_month_spine_fills_gaps(spark):
    m = spark.createDataFrame([("2024-01-01", 10.0), ("2024-02-01", 0.0), ("2024-04-01", 5.0)], "month string, v double") \
             .select(F.to_date("month").alias("month"), "v")
    got = {str(r.month): (r.v, r.prev_v, r.change) for r in bz.mom(m, "v").collect()}
    assert got == {"2024-01-01": (10.0, None, None), "2024-02-01": (0.0, 10.0, -1.0),
                   "2024-03-01": (0.0, 0.0, None), "2024-04-01": (5.0, 0.0, None)}


def test_ingest_stream_resumes_without_duplicates(spark):
    e = load(spark, SF_SMALL, "events")
    base = scratch_path(spark, "t-st1")
    inbox, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    e.filter(F.col("event_id") < 500).write.parquet(inbox, mode="append")
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])
    n1 = spark.read.parquet(out).count()
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])
    assert spark.read.parquet(out).count() == n1 == 500
    e.filter(F.col("event_id") >= 500).write.parquet(inbox, mode="append")
    st.ingest(spark, inbox, out, ck, SCHEMAS["events"])
    assert spark.read.parquet(out).count() == e.count()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
