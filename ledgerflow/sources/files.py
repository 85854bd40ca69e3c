"""SRC-2 delimited files with declared types, SRC-3 JSON payload columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_bad"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """Typed read that keeps malformed rows: they come back with the fields
    that did parse, NULL for those that did not, and the raw line in
    ``_bad``. Never infers a schema (inference would need its own pass over
    the files).

    Whether a line is malformed shows only when all its fields are parsed,
    so ``_bad`` is tied to every field (by an always empty suffix): a query
    that selects or counts ``_bad`` alone still reads whole lines."""
    if isinstance(schema, str):
        if BAD not in schema:
            schema = f"{schema}, {BAD} string"
    elif BAD not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(BAD, T.StringType(), True)])
    df = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).csv(path))
    fields = [c for c in df.columns if c != BAD]
    nothing = F.substring(F.xxhash64(*fields).cast("string"), 1, 0)
    return df.withColumn(BAD, F.concat(BAD, nothing))


def flatten_json(df: DataFrame, col: str, schema: T.StructType | str, drop: bool = True) -> DataFrame:
    """Replace a JSON string column by typed columns; an absent key gives
    NULL, a non-JSON value gives NULL in every field."""
    out = df.withColumn("_json", F.from_json(F.col(col), schema))
    keep = [c for c in df.columns if not (drop and c == col)]
    return out.select(*keep, "_json.*")


#: What JSON values a declared type takes without loss, by the kind of the value.
_TAKES = {"int": ("integer",), "bigint": ("integer",), "double": ("integer", "decimal"), "decimal": ("integer", "decimal"), "string": ("string",),
          "boolean": ("boolean",), "struct": ("object",), "map": ("object",), "array": ("array",)}


def payload_keys(df: DataFrame, col: str, declared: T.StructType | str) -> DataFrame:
    """(key, kind, n_rows, status): what a JSON column holds against what is
    declared. Payloads are parsed as variants, so no key is lost to a schema;
    each top-level key is reported once per kind of value: ``ok``, ``conflict``
    (declared with a type that the value does not fit) or ``unknown``. Text
    that is no JSON object is one row without a key. NULL payloads count for
    nothing, null values fit any type. Keys are counted in every task before they move."""
    fields = T._parse_datatype_string(declared) if isinstance(declared, str) else declared
    v = F.try_parse_json(F.col(col))
    kind_of = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    x = df.filter(F.col(col).isNotNull()).select(F.when(kind_of == "OBJECT", v).alias("_v"))
    x = x.select("_v", F.when(F.col("_v").isNull(), F.lit(1)).alias("_bad"))
    spark = df.sparkSession
    each = x.filter("_bad is null").lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select("key", F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0).alias("t"))
    kind = F.expr("case when t in ('BIGINT') then 'integer' when t in ('DECIMAL', 'DOUBLE', 'FLOAT') then 'decimal' when t = 'VOID' then 'null' else lower(t) end")
    per = each.select("key", kind.alias("kind")).unionByName(x.filter("_bad = 1").select(F.lit(None).cast("string").alias("key"), F.lit("malformed").alias("kind")))
    per = per.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n_rows"))
    status = F.lit("unknown")
    for f in fields.fields:
        fits = F.col("kind").isin("null", *_TAKES.get(f.dataType.typeName().replace("integer", "int").replace("long", "bigint"), ()))
        status = F.when(F.col("key") == f.name, F.when(fits, "ok").otherwise("conflict")).otherwise(status)
    return per.withColumn("status", F.when(F.col("key").isNull(), "malformed").otherwise(status))
