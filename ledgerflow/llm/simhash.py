"""SimHash near-dedup: byte-position inverted index with count filtering.

A text's fingerprint takes XXH64 (seed 42) of every word shingle, repeats
included; bit b is set where over half of the hashes have it. Texts link
where their fingerprints differ in at most ``max_bits`` bits.

Index. A fingerprint is eight positional bytes. Differing bits spoil at most
as many bytes, so linked fingerprints share at least ``8 - max_bits`` of
them: the guaranteed minimum. A list per (position, byte) holds a 256th of
the corpus, and tallying pairs over such lists would be all pairs again, so
lists are kept already intersected: one per choice of that many positions
and the bytes there (28 choices of six positions for two bits). Every pair
whose tally reaches the minimum meets in at least one list, and no other
pair is ever formed. Each pair's shared bytes are then counted and its
bit distance verified.

Hot lists. Fingerprints are distinct before they are indexed, so a list has
at most 256**max_bits of them (65,536), whatever the number of copies. A list
of over ``PAIRED`` fingerprints is not paired up: each fingerprint looks up
the 136 values that differ from its free bytes in one or two bits, and only the
list's linked groups leave the task, one row per fingerprint.

Nulls and odd rows: a null text is the empty text; texts without words have
fingerprint zero and link like others; a null id keeps its fingerprint and
takes the smallest id of its group (null where the group has none);
repeated rows share a group; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import components
from .common import binary_column, run_starts, sorted_runs, stored, text_or_empty

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Lists up to this long are compared pair by pair, longer ones by lookup.
PAIRED = 16


def simhash(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Fingerprint of a word sequence; zero without words."""
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [a + b" " + b + b" " + c for a, b, c in zip(words, words[1:], words[2:])]
    else:
        grams = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    h = np.array(list(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams)), dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprinter(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [simhash(t.lower().split(), shingle) for t in binary_column(b, "text")]
            yield pa.record_batch([b.column(0), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))],
                                  names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return x.mapInArrow(_fingerprinter(shingle), "doc_id long, fp long")


def byte_choices(max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the positions that linked fingerprints may share."""
    return [sum(0xFF << 8 * p for p in kept) for kept in combinations(range(8), 8 - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near_by_lookup(fp: np.ndarray, mask: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, smallest-placed fp of its group) within one list: the free
    bytes' values are looked up after each flip of one to ``max_bits`` bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    flips = np.array([sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(free, k)], dtype=np.uint64)
    order = np.argsort(fp)
    fp = fp[order]
    label = np.arange(len(fp))
    while True:
        new = label.copy()
        for f in flips:
            at = np.minimum(np.searchsorted(fp, fp ^ f), len(fp) - 1)
            hit = fp[at] == fp ^ f
            new[hit] = np.minimum(new[hit], label[at[hit]])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(fp))
    return fp[far], fp[label[far]]


def _verifier(max_bits: int) -> Callable:
    masks = byte_choices(max_bits)

    def links(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        choice, key, fp = (t.column(c).to_numpy() for c in ("choice", "key", "fp"))
        fp = fp.view(np.uint64)
        at = run_starts(choice, key)
        size = np.repeat(np.diff(at), np.diff(at))
        us, vs = [], []
        for d in range(1, PAIRED):  # every pair of a short list is d places apart for one d
            if d >= len(fp):
                break
            i = np.flatnonzero((key[d:] == key[:-d]) & (choice[d:] == choice[:-d]) & (size[d:] <= PAIRED))
            differ = fp[i] ^ fp[i + d]
            tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            ok = (tally >= 8 - max_bits) & (np.bitwise_count(differ) <= max_bits)
            us.append(fp[i[ok]])
            vs.append(fp[i[ok] + d])
        for k in np.flatnonzero(np.diff(at) > PAIRED):
            u, v = _near_by_lookup(fp[at[k]:at[k + 1]], masks[choice[at[k]]], max_bits)
            us.append(u)
            vs.append(v)
        none = np.array([], dtype=np.uint64)
        return np.concatenate([none, *us]), np.concatenate([none, *vs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_runs(batches, ["choice", "key"]):
            u, v = links(t)
            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) that keep
    every group together; short lists give all their pairs."""
    masks = byte_choices(max_bits)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                               for i, m in enumerate(masks)]))
    lists = fps.select("fp", keys.alias("k")).select("k.choice", "k.key", "fp")
    lists = lists.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return lists.mapInArrow(_verifier(max_bits), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprint as 16 hex digits,
    component_id the smallest id reachable by links."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))  # one row per distinct fingerprint
    groups = components(stored(fingerprint_links(nodes.select("fp"), max_bits), "simhash-links"))
    named = nodes.join(groups, nodes["fp"] == groups["node"], "left") \
                 .select("fp", "first", F.coalesce("cluster", "fp").alias("cluster"))
    lowest = named.groupBy("cluster").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "cluster").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
