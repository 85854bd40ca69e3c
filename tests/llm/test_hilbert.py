import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from ledgerflow.llm import hilbert
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs


@pytest.mark.parametrize(("d", "bits"), [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_once_in_unit_steps(d, bits):
    n = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(n)] * d, indexing="ij")).reshape(d, -1)
    index = hilbert.hilbert_index(list(points), bits)
    assert sorted(index) == list(range(n ** d))
    path = points[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def check(rows, docs, shards=40):
    want = collections.Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query_places_every_row(spark):
    rows = E.queries()["op7_hilbert"](spark, SF_MID).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    check(rows, docs)
    along = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in along] == sorted(r.curve for r in rows)


def test_runs_prune_every_dimension(spark):
    """A run spans fewer values of each dimension than the same cut of rows
    in id order does, on average."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = hilbert.shard_documents(docs, shards=20).join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    by_id = sorted(out, key=lambda r: r.doc_id)
    for column in ("lang", "source", "size"):
        kinds = lambda r, c=column: r[c] if c != "size" else int(np.log2(r["size"]))
        curve = np.mean([len({kinds(r) for r in out if r.shard == s}) for s in range(20)])
        plain = np.mean([len({kinds(r) for r in by_id[i:i + 50]}) for i in range(0, 1000, 50)])
        assert curve < 0.8 * plain, column


def test_hot_cell_is_cut_like_any_other(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text"),
                                 F.lit("en").alias("lang"), F.lit("src0").alias("source"))
    rows = hilbert.shard_documents(df).collect()
    check(rows, [(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows(spark):
    df = odd_docs(spark).withColumn("shard", F.lit("clash")).withColumn("slot", F.lit("clash"))
    check(hilbert.shard_documents(df).collect(), [(r.doc_id, r.text) for r in df.collect()])


def test_empty_table(spark):
    assert hilbert.shard_documents(empty_docs(spark)).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("slot", F.lit("own"))
    path = str(tmp_path / "shards")
    hilbert.write_shards(docs, path, shards=8)
    back = spark.read.parquet(path)
    assert back.select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()
    sizes = [r["count"] for r in back.groupBy("_shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1


def test_strings_with_a_common_beginning_fill_many_cells(spark):
    rows = [(i, f"https://www.example.org/section/{i % 20:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, source string")
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    for few in (hilbert.FEW_VALUES, 3):
        hilbert.FEW_VALUES, before = few, hilbert.FEW_VALUES
        x = hilbert.with_number(df, F.col("source"), T.StringType(), "_d0")
        hilbert.FEW_VALUES = before
        assert sorted({(r.source, r["_d0"]) for r in x.collect()}) == [(f"https://www.example.org/section/{i:02d}", float(i)) for i in range(20)]
    got, _ = hilbert.order_along_curve(df, [(F.col("source"), T.StringType())], [F.col("id")])
    assert len({r["_curve"] for r in got.collect()}) == 20


def test_ranks_of_few_strings_need_no_join(spark):
    values = ["b", None, "", "é", "a\x00", "a", "z'\\", "a", "\U0001f600"]
    df = spark.createDataFrame(list(enumerate(values)), "id long, source string")
    order = sorted({v for v in values if v is not None}, key=str.encode)
    want = {i: None if v is None else float(order.index(v)) for i, v in enumerate(values)}
    for listed, few, join in ((200, 100_000, None), (3, 100_000, "BroadcastHashJoin"), (3, 3, "Join")):
        before = hilbert.LISTED_VALUES, hilbert.FEW_VALUES
        hilbert.LISTED_VALUES, hilbert.FEW_VALUES = listed, few
        try:
            x = hilbert.with_number(df, F.col("source"), T.StringType(), "_d0")
        finally:
            hilbert.LISTED_VALUES, hilbert.FEW_VALUES = before
        assert {r.id: r._d0 for r in x.collect()} == want
        plan = x._jdf.queryExecution().toString()
        assert join in plan if join else "Join" not in plan
    nothing = hilbert.with_number(df.filter("id = 1"), F.col("source"), T.StringType(), "_d0")
    assert [r._d0 for r in nothing.collect()] == [None]
