"""Best-fit packing of token sequences by bulk-synchronous rounds.

Documents become pieces of at most ``capacity`` tokens; pieces are packed
into sequences of at most ``capacity`` tokens, in as few as best-fit
decreasing needs.

Method. All pieces of one length form an
interval of ranks (the rank of a piece among its length is found on the
executors from per-partition counts). The matching itself is a loop on the
driver over the histogram of lengths, not a distributed sweep. Gaps, the open sequences, are kept
sorted by room left, as runs of sequences with equal room. A round takes the
longest length not yet placed and goes through the gaps upward from its successor,
the smallest room that holds it: the k-th piece goes to the k-th sequence of
the run (conflicts are settled by rank, in bulk), the run's room is updated
and moves down the order, and so on until the length is placed
or no gap is left, when new sequences open. Pieces of one length and gaps of
equal room are interchangeable, so a round moves whole rank intervals: its
state has at most ``capacity`` lengths and three runs a length, whatever
the number of documents. Placing the pieces themselves is one pass without a
shuffle of their tokens: each piece looks up the interval that holds its rank.

Nulls and odd rows: a null text is the empty text (one piece: the end id);
a null or repeated id is packed like any other, once per row; ties in length
go by place in the table; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty

CAPACITY = 2048
END_ID = 0
#: Distinct words a Python worker remembers (about 100 MB); beyond it words
#: are looked up again, batch by batch.
CACHE_WORDS = 300_000

# Bytes that byte-level BPE files write as themselves.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_letters() -> dict[int, str]:
    """Byte -> its letter in a byte-level vocabulary; the bytes that have no
    plain letter take U+0100, U+0101, ... in order."""
    rest = (b for b in range(256) if b not in set(PLAIN_BYTES))
    return {b: chr(b) for b in PLAIN_BYTES} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Chunk between spaces -> its ids as little-endian uint32 bytes.

    The tokenizer drops white space and never merges across it, so a text's
    ids are its chunks' ids in a row. Latin words, the bulk of misses, go to
    the tokenizer's BPE model directly; every other chunk takes the whole
    tokenizer. Both give the same ids (tested over whole texts).
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.limit = limit

    def _latin(self, word: str) -> bytes | None:
        """Ids of a word of letters below U+0250, which NFC leaves alone and
        the splitting pattern keeps in one piece; None for other chunks."""
        low = word.lower()
        if not (low.isalpha() and max(low) < "ɐ"):
            return None
        piece = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self._latin(chunk)
        if ids is None and chunk[-1] in ",." and len(chunk) > 1 and chunk[:-1].isalpha() and chunk[:-1].lower().isalpha() \
                and max(chunk) < "ɐ":
            ids = self[chunk[:-1]] + self[chunk[-1]]
        if ids is None:
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < self.limit:
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_CACHES: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache for each worker process, kept from task to task."""
    if path not in _CACHES:
        _CACHES[path] = WordIds(path)
    return _CACHES[path]


def _piece_maker(path: str, capacity: int, with_ids: bool) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("nth", pa.int64())]
                       + ([("ids", pa.binary())] if with_ids else []))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        seen = [0] * (capacity + 1)  # pieces of each length so far in this partition
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = cache.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append((doc, k, k * capacity, n, zlib.crc32(cut), seen[n]) + ((cut,) if with_ids else ()))
                    seen[n] += 1
            cols = list(zip(*rows)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    return make


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, nth, part[, ids]): the
    documents' token sequences, cut where longer than ``capacity``. ``part``
    and ``nth`` number the pieces of one length in one partition; ``ids``
    holds the piece's ids as little-endian uint32."""
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long" + (", ids binary" if with_ids else "")
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return x.mapInArrow(_piece_maker(tokenizer, capacity, with_ids), out).withColumn("part", F.spark_partition_id())


def best_fit_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rounds of best fit over length classes, longest first.

    Returns (intervals, sequences). An interval (length, first_rank, per,
    first_sequence, offset) places the pieces of that length from first_rank
    on (up to the next interval's first_rank): ``per`` to a sequence, in
    sequences counted from first_sequence, at ``offset`` and on.
    """
    gaps: list[tuple[int, int, int]] = []  # (room, first sequence, sequences), by room
    intervals, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            bisect.insort(gaps, (room, first, n))

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(gaps, (size,))  # the successor
            fresh = at == len(gaps)
            room, first, n = (capacity, opened, -(-left // (capacity // size))) if fresh else gaps.pop(at)
            opened += n * fresh
            # The tightest gap stays the tightest until it holds no more: fill it, then the run's next.
            per = room // size
            whole = min(n, left // per)
            if whole:
                intervals.append((size, rank, per, first, capacity - room))
                put(room - per * size, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < n and left:  # fewer than per are left: one sequence takes them
                intervals.append((size, rank, per, first + whole, capacity - room))
                put(room - left * size, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            put(room, first + whole, n - whole)
    return intervals, opened


def _placer(intervals: list[tuple[int, int, int, int, int]], names: list[str]) -> Callable:
    table = np.array(sorted(intervals), dtype=np.int64).reshape(-1, 5)
    # (length, rank) order as one sortable number; ranks stay below 2**48.
    starts = (table[:, 0] << 48) + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = (b.column(b.schema.get_field_index(n)).to_numpy() for n in ("length", "_rank"))
            _, first_rank, per, first, offset = table[np.searchsorted(starts, (size << 48) + rank, "right") - 1].T
            k = rank - first_rank
            yield pa.record_batch([*(b.column(b.schema.get_field_index(n)) for n in names),
                                   pa.array(first + k // np.maximum(per, 1)),
                                   pa.array(offset + k % np.maximum(per, 1) * size)],
                                  names=[*names, "sequence_id", "offset"])
    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``cut_pieces`` rows, which must come
    from storage (``stored``): part and nth are read twice."""
    spark = pieces.sparkSession
    each = pieces.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    totals = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    intervals, _ = best_fit_rounds(totals, capacity)
    # Pieces of this length in earlier partitions: the window's groups have a row per partition at most.
    before = each.select("length", "part", F.expr(
        "sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n").alias("_before"))
    names = [c for c in pieces.columns if c not in ("nth", "part")]
    x = pieces.join(before, ["length", "part"]).select(*names, (F.col("_before") + F.col("nth")).alias("_rank"))
    out = ", ".join(f"`{n}` {pieces.schema[n].dataType.simpleString()}" for n in names) + ", sequence_id long, offset long"
    return x.mapInArrow(_placer(intervals, names), out) if totals else \
        spark.createDataFrame([], out)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Cut, then pack: (doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset), one row per piece."""
    pieces = stored(cut_pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "pieces")
    return pack(pieces, capacity)
