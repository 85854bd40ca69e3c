"""SRC-1: load a named table under a declared schema contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Declared contracts of the fixture tables (column order as stored).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())),
                          ("label", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}


class SchemaContractError(ValueError):
    """A stored table disagrees with its declared contract."""


def contract_violations(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, problem, expected, actual) for every difference; empty if none.

    Nullability is reported only when the contract demands NOT NULL and the
    file allows NULLs (Parquet columns are always written nullable by Spark).
    """
    out: list[tuple[str, str, str, str]] = []
    have = {f.name: f for f in actual.fields}
    want = {f.name: f for f in expected.fields}
    for name, f in want.items():
        if name not in have:
            out.append((name, "missing", f.dataType.simpleString(), ""))
            continue
        g = have[name]
        if g.dataType != f.dataType:
            out.append((name, "type", f.dataType.simpleString(), g.dataType.simpleString()))
        if not f.nullable and g.nullable:
            out.append((name, "nullable", "not null", "nullable"))
    for name, g in have.items():
        if name not in want:
            out.append((name, "unexpected", "", g.dataType.simpleString()))
    return out


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Read ``name`` and enforce its contract; raises naming the bad column.

    The footer schema is metadata only, so the check costs no data scan. The
    frame is then read with the declared schema so later code never depends on
    what the file happens to say.
    """
    expected = schema or SCHEMAS[name]
    path = table_path(sf_dir, name)
    stored = spark.read.parquet(path)
    bad = contract_violations(stored.schema, expected)
    if bad:
        desc = "; ".join(f"{c}: {p} (expected {e or '-'}, found {a or '-'})" for c, p, e, a in bad)
        raise SchemaContractError(f"table {name} breaks its contract: {desc}")
    return spark.read.schema(expected).parquet(path)


def load_all(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in (names or SCHEMAS)}


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Expose the fixture tables to ``spark.sql`` under their own names."""
    for n, df in load_all(spark, sf_dir, names).items():
        df.createOrReplaceTempView(n)
