"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``2**bits`` cells at its own quantiles (a
string counts as its rank among the distinct values, so cells keep its order,
whatever beginnings the values share);
a row's cells give its index on the Hilbert curve; rows are sorted by that
index and cut into runs. Neighbours on the curve are close in every
dimension at once, so a run, one file, spans a small box and a filter on any
of the dimensions skips most files by their min/max statistics.

Law ``rows``: shards' row counts differ by one at most. Ranks come from a
range shuffle with per-partition counts, so no task sees more than its range
and a cell that holds a third of all rows is cut like any other. Within a
cell rows follow text checksum and id: equal texts lie side by side.

Nulls and odd rows: a null dimension takes the lowest cell; a null text has
no bytes and the empty text's checksum; null and repeated ids and repeated
rows are placed once per row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ranked, text_or_empty

BITS = 5
SHARDS = 40
#: What a row takes besides its text.
ROW_BYTES = 16
#: Distinct values of a string dimension that are looked up without a join.
LISTED_VALUES = 200
#: Distinct values of a string dimension whose ranks are broadcast.
FEW_VALUES = 100_000


def hilbert_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points given by one array of cells per
    dimension (Skilling's transform, AIP Conf. Proc. 707, 2004)."""
    x = [np.asarray(c, dtype=np.int64).copy() for c in cells]
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the top bit down
        low = q - 1
        for i in range(d):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(x[i] & q, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[d - 1] & q, q - 1, 0)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            index = index << 1 | ((x[i] ^ flip) >> b) & 1
    return index


def with_number(df: DataFrame, c: Column, kind: T.DataType, name: str) -> DataFrame:
    """``df`` with an order-keeping number of ``c``: a string's rank among its
    distinct values, which come from one range shuffle of these alone. The
    rank of a few is its place in a list: joins would leave a broadcast table
    per dimension in every executor, each time the rows are read."""
    if not isinstance(kind, T.StringType):
        return df.withColumn(name, c.cast("double"))
    few = min(LISTED_VALUES, FEW_VALUES)
    some = [r[0] for r in df.select(c).distinct().limit(few + 2).collect()]  # few + 2 values at most
    if len(some) <= few:
        listed = [F.lit(v) for v in sorted((v for v in some if v is not None), key=lambda v: v.encode())]
        place = F.array_position(F.array(*listed), c) - 1 if listed else F.lit(None)
        return df.withColumn(name, place.cast("double"))
    x = df.withColumn("_value", c)
    values, n = ranked(x.select("_value").filter("_value is not null").distinct(), [F.col("_value")], "hilbert-values")
    values = values.select("_value", F.col("_rank").cast("double").alias(name))
    return x.join(F.broadcast(values) if n <= FEW_VALUES else values, "_value", "left").drop("_value")


def _curve(cuts: list[np.ndarray], bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            cells = []
            for i, cut in enumerate(cuts):
                v = b.column(names.index(f"_d{i}")).to_numpy(zero_copy_only=False).astype(float)
                cells.append(np.where(np.isnan(v), 0, np.searchsorted(cut, v, "left")))
            yield pa.record_batch([*b.columns, pa.array(hilbert_index(cells, bits), pa.int64())], names=[*names, "_curve"])
    return run


def order_along_curve(df: DataFrame, dims: Sequence[tuple[Column, T.DataType]], tie: Sequence[Column], bits: int = BITS,
                      name: str = "hilbert") -> tuple[DataFrame, int]:
    """(df with ``_curve`` and ``_rank``, row count): all rows of ``df``
    ranked by curve index, then ``tie``."""
    columns = df.columns
    x = df
    for i, (c, kind) in enumerate(dims):
        x = with_number(x, c, kind, f"_d{i}")
    x = x.select(*columns, *(f"_d{i}" for i in range(len(dims))))
    names = [f"_d{i}" for i in range(len(dims))]
    cells = 1 << bits
    found = x.approxQuantile(names, [i / cells for i in range(1, cells)], 0.2 / cells)
    # A value that fills several quantiles takes the first one's cell and leaves the others empty.
    cuts = [np.array(c, dtype=float) for c in found]
    out = T.StructType([*x.schema.fields, T.StructField("_curve", T.LongType())])
    x = x.mapInArrow(_curve(cuts, bits), out).drop(*names)
    return ranked(x, [F.col("_curve"), *tie], name)


def cut_runs(ranked_rows: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """Adds shard and slot to rows with ``_rank``: runs of equal count."""
    n = max(total, 1)
    x = ranked_rows.withColumn("shard", F.expr(f"cast((_rank * {shards}L) div {n}L as int)"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return x.withColumn("slot", F.col("_rank") - first)


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    dims: Sequence[str] = ("lang", "source"), bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, law, shard, slot, grown_shard): the
    metadata ``dims``, the size and the id are the curve's dimensions."""
    text = text_or_empty(text_col)
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                    F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                    *(F.col(c).alias(f"_m{i}") for i, c in enumerate(dims)))
    axes = [(F.col(f"_m{i}"), kinds[c]) for i, c in enumerate(dims)] + [(F.col("size"), T.LongType()), (F.col("doc_id"), T.LongType())]
    rows, total = order_along_curve(x, axes, [F.col("text_crc32"), F.col("doc_id")], bits)
    return cut_runs(rows, total, shards).select("doc_id", "size", "text_crc32", F.col("_curve").alias("curve"),
                                                F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 dims: Sequence[str] = ("lang", "source"), bits: int = BITS) -> None:
    """Write whole documents as one folder per shard (``_shard=k``), rows in
    curve order, so that readers prune files by any dimension. The input
    must not have columns named _shard, _rank or _curve."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    axes = [(F.col(c), kinds[c]) for c in dims] + [(F.octet_length(text_or_empty(text_col)), T.LongType()),
                                                   (F.col(id_col).cast("long"), T.LongType())]
    rows, total = order_along_curve(docs, axes, [F.xxhash64(text_col), F.col(id_col)], bits, "hilbert-full")
    x = cut_runs(rows.withColumnsRenamed({c: f"_in_{c}" for c in ("shard", "slot") if c in docs.columns}), total, shards)
    x = x.withColumnRenamed("shard", "_shard").drop("slot").withColumnsRenamed({f"_in_{c}": c for c in ("shard", "slot") if c in docs.columns})
    x = x.repartitionByRange("_shard", "_rank").sortWithinPartitions("_shard", "_rank")
    x.select(*docs.columns, "_shard").write.partitionBy("_shard").parquet(path)
