"""Embedding near-dedup: Euclidean p-stable hashing, exact cosine checks.

Buckets. Unit vectors are projected on Gaussian directions; each projection,
shifted and divided by ``width``, is rounded down, and ``HASHES`` of them make
the bucket of one of ``TABLES`` tables. Two unit vectors of cosine c are
sqrt(2 - 2c) apart; at the threshold 0.9 one projection agrees with
probability 0.82, a table's 16 with 0.042, and 64 tables meet 93 % of such
pairs (99.9 % at 0.95); unrelated vectors share a table with 1e-5.

Checks. Vectors that share a bucket are compared in double precision; only
pairs of cosine >= ``COSINE`` link. A pair that meets in several tables is
counted in the first: vectors and directions are rounded to integers small
enough that projections are exact in double arithmetic, so buckets are the
same wherever they are computed.

Hot buckets. Equal vectors are one class with a count from the start. A
bucket with one class is dropped before any vector is moved. A bucket of more
than ``BLOCK`` classes is split by hash into blocks, and every two blocks meet
in a task of their own. No task writes pairs: it adds up each class's links
and passes on one edge per linked class, to the smallest of its linked group.

Vectors that are null, zero, or hold null or non-finite components, link with
nothing (own component, kept); so do vectors of another length than most
rows would pair with, as only equal lengths are compared. A null id gives a
row with null component; rows that repeat an id are rows of their own with
the same vector class and link with each other if the vector is valid. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import components
from .common import run_starts, sorted_runs, stored

COSINE = 0.9
TABLES = 64
HASHES = 16
WIDTH = 2.0
BLOCK = 2048
SEED = 5
#: Rounding of unit vectors and directions: products of 2**20 and 2**18 (and
#: sums of thousands of them) are exact in doubles.
UNIT, STEP = float(1 << 20), float(1 << 16)
#: Buckets up to this long are compared place by place, all at once.
PAIRED = 32


class Hasher:
    """The tables' buckets of unit vectors."""

    def __init__(self, dim: int, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.directions = np.rint(rng.standard_normal((dim, tables * hashes)) * STEP)
        self.shift = np.rint(rng.random(tables * hashes) * width * UNIT * STEP)
        self.width = width * UNIT * STEP
        self.mix = rng.integers(1, 1 << 62, (tables, hashes), dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.shape = (tables, hashes)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables) of 64-bit bucket keys."""
        cells = np.floor((np.rint(unit * UNIT) @ self.directions + self.shift) / self.width).astype(np.int64)
        keys = (cells.reshape(-1, *self.shape).view(np.uint64) * self.mix).sum(axis=2, dtype=np.uint64)
        keys ^= keys >> np.uint64(29)
        return (keys * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


_HASHERS: dict[int, Hasher] = {}


def hasher(dim: int) -> Hasher:
    if dim not in _HASHERS:
        _HASHERS[dim] = Hasher(dim)
    return _HASHERS[dim]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Equally long vectors, given as bytes, as unit rows in doubles."""
    v = np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1).astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _bytes_of(kind: str) -> Callable:
    """(vec_id, vec): a valid vector's components as bytes, else null. A vector
    of doubles is scaled by its largest component, so that the square of its
    length stays finite; floats need none, and move in half the bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column(1).to_pylist():
                a = np.array(v, dtype=kind) if v is not None and None not in v else np.zeros(0)
                top = np.abs(a).max() if len(a) else 0.0
                ok = top > 0 and np.isfinite(a).all()
                out.append((a / top if kind == "<f8" else a).tobytes() if ok else None)
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])
    return run


def _bucketer(kind: str) -> Callable:
    """(dim, tab, bucket, cls): every class's place in every table."""
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = b.column(0).to_numpy()
            size = np.array([len(v) // width for v in b.column(1).to_pylist()], dtype=np.int32)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                keys = hasher(int(n)).buckets(_matrix(b.column(1).take(pa.array(at)), kind))
                rows, tables = keys.shape
                yield pa.record_batch([pa.array(np.full(rows * tables, n, dtype=np.int32)), pa.array(np.tile(np.arange(tables, dtype=np.int32), rows)),
                                       pa.array(keys.ravel()), pa.array(np.repeat(cls[at], tables))], names=["dim", "tab", "bucket", "cls"])
    return run


def _first_here(x: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether the pairs (i, j) of rows of ``x`` meet in no earlier table."""
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    keys = hasher(x.shape[1]).buckets(x[used])
    a, b = place[:len(i)], place[len(i):]
    out = np.empty(len(i), dtype=bool)
    for k in range(0, len(i), 100_000):
        s = slice(k, k + 100_000)
        out[s] = (keys[a[s]] == keys[b[s]]).argmax(axis=1) == table[s]
    return out


def _groups(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linker(cosine: float, kind: str) -> Callable:
    keys = ["dim", "tab", "bucket", "b1", "b2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_runs(batches, keys, rows=8192):
            cols = [t.column(k).to_numpy() for k in keys]
            cls, n, tab, block = (t.column(c).to_numpy() for c in ("cls", "n", "tab", "block"))
            vec = t.column("vec").combine_chunks()
            at = run_starts(*cols)
            dims = cols[0]
            starts = run_starts(dims)
            for s, e in zip(starts[:-1], starts[1:]):  # one vector length at a time
                x = _matrix(vec.slice(int(s), int(e - s)), kind)
                own = at[(at >= s) & (at < e)] - s
                yield _links(x, cls[s:e], n[s:e], tab[s:e], block[s:e], cols[3][s:e], cols[4][s:e], np.append(own, e - s))

    def _links(x, cls, n, tab, block, b1, b2, at) -> pa.RecordBatch:
        size = np.diff(at)
        run_of = np.repeat(np.arange(len(size)), size)
        small = size <= PAIRED
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(1, PAIRED):
            if d >= len(x):
                break
            i = np.flatnonzero((run_of[d:] == run_of[:-d]) & small[run_of[d:]])
            i = i[(b1[i] == b2[i]) | (block[i] != block[i + d])]
            ok = np.einsum("ij,ij->i", x[i], x[i + d]) >= cosine if len(i) else np.zeros(0, dtype=bool)
            found.append((i[ok], i[ok] + d))
        for g in np.flatnonzero(~small):
            rows = np.arange(at[g], at[g + 1])
            first = rows[block[rows] == b1[rows]]
            second = rows[block[rows] == b2[rows]]
            for k in range(0, len(first), 512):
                part = first[k:k + 512]
                i, j = np.nonzero(x[part] @ x[second].T >= cosine)
                i, j = part[i], second[j]
                ok = i < j if b1[at[g]] == b2[at[g]] else i != j
                found.append((i[ok], j[ok]))
        i, j = (np.concatenate([np.zeros(0, dtype=int), *(f[k] for f in found)]) for k in (0, 1))
        links = np.zeros(len(x), dtype=np.int64)
        if len(i):
            mine = _first_here(x, i, j, tab[i])
            np.add.at(links, i[mine], n[j[mine]])
            np.add.at(links, j[mine], n[i[mine]])
        lead = _groups(len(x), i, j)
        linked = np.zeros(len(x), dtype=bool)
        linked[i] = linked[j] = True
        low = np.full(len(x), np.iinfo(np.int64).max)
        np.minimum.at(low, lead, cls)  # the smallest class of each linked group
        return pa.record_batch([pa.array(cls[linked]), pa.array(links[linked]), pa.array(low[lead][linked])], names=["cls", "links", "lead"])
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept): n_links counts the other
    vectors found linked directly; component_id is the smallest id reachable."""
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind, cast = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(cast).alias("v"))
    x = stored(x.mapInArrow(_bytes_of(kind), "vec_id long, vec binary"), "vectors")
    classes = x.filter("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    # A class goes by a number of its own: null ids have no number to lend.
    classes = stored(classes.select("vec", "n", "first").withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    places = stored(classes.select("cls", "vec").mapInArrow(_bucketer(kind), "dim int, tab int, bucket long, cls long"), "buckets")
    shared = places.groupBy("dim", "tab", "bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = places.join(shared, ["dim", "tab", "bucket"])
    # Blocks of a hot bucket meet two by two; others have one block.
    blocks = F.expr(f"cast((members + {block - 1}) div {block} as int)")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("dim", "tab", "bucket", "cls", "block", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    rows = rows.join(classes.select("cls", "vec", "n"), "cls")
    keys = ["dim", "tab", "bucket", "b1", "b2"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)
    found = stored(rows.mapInArrow(_linker(cosine, kind), "cls long, links long, lead long"), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.filter("cls <> lead").select(F.col("cls").alias("u"), F.col("lead").alias("v")).distinct()
    groups = components(edges)
    named = classes.join(groups, classes["cls"] == groups["node"], "left").select("vec", "n", "first", "cls", F.coalesce("cluster", "cls").alias("cluster"))
    lowest = named.groupBy("cluster").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "cluster").join(links, "cls", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = x.join(named, "vec", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                              F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
