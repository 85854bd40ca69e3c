"""Helpers shared by the training-data operators.

Every operator follows the same rules: it selects the columns it needs
before adding its own (extra input columns can't clash), reads a null text
as the empty text, and keeps one output row per input row, repeated rows and
null ids included, unless its docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare as prepare_session
from ..session import scratch_path
from ..sources.tables import table_path

#: Rows per Arrow batch: texts run to 100 KB and more, so Spark's 10,000 rows
#: could be a gigabyte in a Python worker.
ARROW_ROWS = 500

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+``. ``bytes.split()``
#: splits on exactly these six bytes and ``bytes.lower()`` folds A-Z only.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names made of ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def id_bucket(c: str, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(c).cast("string"), F.lit("")), "UTF-8")), F.lit(n))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps reread
    files instead of recomputing, whichever executors are lost meanwhile."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, int]:
    """(df with ``_rank``, row count): 0-based rank in a total order.

    A range shuffle and a sort in each partition give every row its place
    within its partition; the partitions' row counts, one number each, give
    the places before them. Rows that tie in ``order`` are told apart by
    their place in the input, so a third of all rows may be equal.
    """
    tie = F.monotonically_increasing_id()
    x = df.withColumn("_tie", tie).repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, "_tie")
    x = stored(x.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    seen = x.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per partition
    before, total = [], 0
    for r in sorted(seen, key=lambda r: r["_part"]):
        before.append((r["_part"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(before, "_part long, _before long")
    x = x.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return x.withColumn("_rank", F.col("_before") + place).drop("_place", "_part", "_before"), total


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, without decoding."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.binary()).to_pylist()


def split_words(texts: pa.Array, table: np.ndarray, mark: bytes, first: bool) -> pa.Array:
    """Words of all texts, in Arrow kernels: bytes are mapped by ``table``
    (256 of them), ``mark`` is a word of its own wherever it then stands, and
    stands before (``first``) or after each text; words end at blanks."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    x = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at - at[0]), pa.py_buffer(table[data])])
    mark, nothing = pa.scalar(mark, pa.large_binary()), pa.scalar(b"", pa.large_binary())
    x = pc.binary_join_element_wise(mark, x, nothing) if first else pc.binary_join_element_wise(x, mark, nothing)
    words = pc.split_pattern(pc.replace_substring(x, mark.as_py(), b" " + mark.as_py() + b" "), b" ").flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.binary())


def sorted_runs(batches: Iterable[pa.RecordBatch], keys: Sequence[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (but the last) that never cut a run of
    equal ``keys``. The partition must be sorted by ``keys``; only one table
    and the run across its end are held."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        same = np.ones(n, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            same &= v == v[-1]
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield t.slice(0, last)
        held = t.slice(last).to_batches()
        n -= last
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal keys, and the row count at the end."""
    n = len(keys[0])
    new = np.ones(n, dtype=bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), n)
