"""Bottom-k sketches of shingle hashes.

A text's sketch holds the ``k`` smallest distinct 64-bit hashes of its word
shingles. Sketches of parts merge into the sketch of the whole (the k
smallest of both), and estimate

* resemblance: of the k smallest hashes of the union, the share in both;
* containment of A in B: |A ∩ B| / |A| from the same sample and the counts;
* the number of distinct shingles: (k - 1) / (k-th smallest hash, as a
  fraction of the hash range), exact while fewer than k are held.

Words are ``[^\x20\x09-\x0D]+`` after folding A-Z; a text of fewer words than
a shingle is one shingle, a text without words has the empty sketch. Two
empty sketches resemble each other fully, an empty and a non-empty one not at
all. A null text is the empty text, a null id keeps its row, repeated rows
give repeated rows, an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, text_or_empty

K = 128
SHINGLE = 5
#: Words whose hashes a worker remembers; others are hashed again.
CACHE_WORDS = 300_000
#: Bytes of text aimed at for a task of the neighbour pass (or less, for as
#: many tasks as a shuffle has), and most tasks.
CHUNK_BYTES = 16 << 20
MAX_CHUNKS = 20_000

# Odd multipliers of the finishing mix (splitmix64).
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
ODD = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[bytes, int] = {}


def _word_hash(w: bytes) -> int:
    h = _WORDS.get(w)
    if h is None:
        h = xxhash.xxh64_intdigest(w)
        if len(_WORDS) < CACHE_WORDS:
            _WORDS[w] = h
    return h


def shingle_hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash for every shingle: a polynomial in the words' hashes
    (so words keep their order), mixed."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(_word_hash, words), dtype=np.uint64, count=len(words))
    width = min(shingle, len(w))
    h = np.full(len(w) - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        h = h * ODD + w[i:len(w) - width + 1 + i]
    h ^= h >> np.uint64(30)
    h *= MIX[0]
    h ^= h >> np.uint64(27)
    h *= MIX[1]
    return h ^ (h >> np.uint64(31))


def sketch(text: bytes, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text.lower().split(), shingle))[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of A's shingles that B has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    union = distinct_shingles(merge(a, b, k), k)
    return min(1.0, j * union / distinct_shingles(a, k))


def to_text(a: np.ndarray) -> str:
    """Sketch as base64 of its big-endian hashes: equal sketches, equal strings."""
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def sketches(docs: DataFrame, k: int = K, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, n_distinct): a sketch for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [sketch(t, k, shingle) for t in binary_column(b, "text")]
            yield pa.record_batch([b.column(0), pa.array([to_text(x) for x in s], pa.string()),
                                   pa.array([distinct_shingles(x, k) for x in s], pa.float64())],
                                  names=["doc_id", "fingerprint", "n_distinct"])
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return x.mapInArrow(run, "doc_id long, fingerprint string, n_distinct double")


def merge_sketches(parts: DataFrame, key: str, k: int = K, salts: int = 64) -> DataFrame:
    """(key, fingerprint, n_distinct): one sketch for all parts of a key.

    Each partition first merges what it holds, then ``salts`` groups of a
    key's partial sketches merge, then the key's: a key that holds a third of
    all parts is no larger for any task than the partitions are many. A null
    fingerprint counts as empty; a null key is a key of its own.
    """
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str | None, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(kept), pa.string()), pa.array([to_text(x) for x in kept.values()], pa.string())],
                                   names=["key", "fingerprint"])
        for b in batches:
            for name, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a = from_text(s or "")
                kept[name] = merge(kept[name], a, k) if name in kept else a
            if len(kept) > 10_000:
                yield flush()
                kept.clear()
        yield flush()

    x = parts.select(F.col(key).cast("string").alias("key"), F.col("fingerprint"))
    for by in (["key", "salt"], ["key"]):
        x = x.mapInArrow(held, "key string, fingerprint string")
        if by == ["key", "salt"]:
            x = x.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))).repartition("key", "salt") \
                 .select("key", "fingerprint")
        else:
            x = x.repartition("key")
    x = x.mapInArrow(held, "key string, fingerprint string")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [distinct_shingles(from_text(s), k) for s in b.column(1).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(n, pa.float64())], names=["key", "fingerprint", "n_distinct"])
    return x.mapInArrow(count, "key string, fingerprint string, n_distinct double").withColumnRenamed("key", key)


def _editor(k: int, shingle: int) -> Callable:
    """Rows come sorted, each followed by the document next to it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior = None  # (doc_id, text, sketch) waiting for its next document
        for b in batches:
            rows = []
            names = b.schema.names
            chunk, doc, text, ghost = (b.column(names.index(c)).to_pylist() for c in ("_chunk", "doc_id", "text", "_ghost"))
            for c, d, t, g in zip(chunk, doc, text, ghost):
                now = (c, d, t, sketch(t.encode(), k, shingle))
                if prior is not None:
                    _, pd, pt, ps = prior
                    half = len(pt) // 2
                    edited = (pt[:len(pt) - half] + t[:half]).encode()
                    es = sketch(edited, k, shingle)
                    rows.append((pd, len(pt), hashlib.sha256(edited).hexdigest(), to_text(ps), to_text(es),
                                 resemblance(ps, es, k), resemblance(ps, now[3], k)))
                prior = None if g else now
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    return run


def compare_with_next(docs: DataFrame, k: int = K, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited text and against the next document's, in
    descending id (after the last the first): (doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited text is the text with its last floor(n/2) code points replaced
    by the first as many of the next document.

    Ids are cut into chunks of about ``CHUNK_BYTES`` of text at quantiles of
    the id column; a chunk is sorted in one task and ends in a copy of the
    next chunk's first document. Whole texts move once. Null ids come last;
    rows of one id follow each other by text; a single document is its own
    next one. An id that many rows share, or lack, is cut further by the hash
    of the text, so only copies of one row stay together.
    """
    spark = docs.sparkSession
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = x.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n = min(MAX_CHUNKS, max(size // CHUNK_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = np.unique(np.array(x.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) or [], dtype=np.int64))
    # Ids with more text than two chunks (a missing or repeated one): at most one per chunk. Each has chunks of its own, cut by its texts' hashes.
    per_id = x.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes")).filter(F.col("bytes") > 2 * CHUNK_BYTES).collect()
    hot = {r["doc_id"]: int(r["bytes"] // CHUNK_BYTES + 1) for r in per_id}
    cuts = np.unique(np.concatenate([cuts, *([i - 1, i] for i in hot if i is not None)]).astype(np.int64))
    pieces = np.ones(len(cuts) + 2, dtype=np.int64)  # by chunk of ids, the largest ids first; the last is that without an id
    for i, m in hot.items():
        pieces[len(cuts) + 1 if i is None else len(cuts) - int(np.searchsorted(cuts, i, "left"))] = m
    begin = np.cumsum(pieces) - pieces

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        """Chunk 0 has the largest ids and, within an id, the largest hashes."""
        at = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(dtype=np.int64), "left")
        at = np.where(ids.isna(), len(cuts) + 1, at)
        down = (float(1 << 63) - hashes.to_numpy(dtype=np.float64)) / float(1 << 64)
        return pd.Series(begin[at] + np.minimum((down * pieces[at]).astype(np.int64), pieces[at] - 1))
    x = x.withColumn("_chunk", chunk_of("doc_id", F.xxhash64("text")))
    # The first row of a chunk, in the order below, as (id, text hash): one per chunk.
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.xxhash64("text"))
    firsts = {r["_chunk"]: r["f"] for r in x.groupBy("_chunk").agg(F.max(order).alias("f")).collect()}
    there = sorted(firsts)
    heads = [(firsts[c][1], firsts[c][2], there[i - 1]) for i, c in enumerate(there)]  # the first chunk's ends the last
    heads = F.broadcast(spark.createDataFrame(heads, "h_id long, h_hash long, h_chunk int"))
    ghosts = x.join(heads, x["doc_id"].eqNullSafe(heads["h_id"]) & (F.xxhash64("text") == heads["h_hash"])) \
              .select(F.col("h_chunk").alias("_chunk"), "doc_id", "text")
    # Copies of a first row are ghosts too; one is used, as only it follows the chunk's last row.
    ghosts = ghosts.dropDuplicates(["_chunk"])
    rows = x.select("_chunk", "doc_id", "text", F.lit(False).alias("_ghost")).unionByName(
        ghosts.select("_chunk", "doc_id", "text", F.lit(True).alias("_ghost")))
    key = [F.col("_chunk"), F.col("_ghost"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()]
    rows = rows.repartitionById(int(pieces.sum()), F.col("_chunk")).sortWithinPartitions(*key)
    return rows.mapInArrow(_editor(k, shingle), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double")
