"""Deduplication (DD-1..5).

* DD-1 groups by a SHA-256 of the normalised text, so the shuffle moves 32
  bytes per row instead of whole documents.
* DD-2 keeps the latest row per key with one ``max`` over a struct.
* DD-3 finds every pair within ``k`` edits without an all-pairs scan
  (Pass-Join, Li, Deng, Wang, Feng, PVLDB 2011). A pair may differ by ``k``
  edits, but by no more than a share of its shorter string, so every string
  that can have a partner can be cut into one segment more than its edits; a
  partner keeps one segment intact, shifted by a bounded amount. Segments and
  probe substrings are joined on ``(length, segment no, hash)``; a bitmap of
  the indexed ones, 32 MB at most, drops most probes before they are shuffled. Texts of one
  template share segments without being near: a string whose segment more
  than ``HOT_SEGMENT`` strings share is cut finer, indexed by its rarest
  segments, and needs two of them in a candidate. Texts that share a passage and
  nothing else differ in how often they have each character: a sketch of these
  counts (16 bytes) bounds the distance from below, so such pairs end in the join
  that finds them. Candidate pairs are de-duplicated, and each is verified exactly
  with Spark's banded ``levenshtein(a, b, k)``, in rounds that move about as much
  text as there is; a round's shuffle files go when it is over. Hash
  collisions only add candidates, never lose pairs.
* DD-4 labels connected components with large-star / small-star (Kiveris
  et al., SoCC 2014), one Spark job per round, lineage cut by a reliable
  ``checkpoint()`` in the shared checkpoint folder.
* DD-5 builds one survivor row per cluster with column-wise aggregate rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, keep, shuffles_freed

# Accent folding used before edit-distance comparison.
ACCENTED = "àáâäãåçèéêëìíîïñòóôöõùúûüýÿ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyy"


def normalize_ws(c) -> Column:
    """DD-1 key: lower case, whitespace runs collapsed, trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.lower(c), r"[ \t\n\r]+", " "))


def normalize_key(c) -> Column:
    """DD-3 key: lower case, Latin accents folded, every run of characters
    other than letters and digits (of any script) replaced by one space,
    trimmed. One regex pass over the text."""
    c = F.col(c) if isinstance(c, str) else c
    x = F.translate(F.lower(c), ACCENTED, UNACCENTED)
    return F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))


# --- DD-1 --------------------------------------------------------------------
def exact_dups(df: DataFrame, id_col: str, key: Column, only_repeated: bool = True) -> DataFrame:
    """(id, canonical_id, n_copies): canonical = smallest id with the same
    key. The group statistic is a partial aggregate joined back on the hash;
    a hot key is one row on the small side (AQE splits the big side)."""
    # (id, 32-byte hash) is read twice; written once, so whole texts are
    # normalised and hashed once.
    h = keep(df.select(F.col(id_col), F.sha2(key, 256).alias("_h")), "dd1-hashes")
    g = h.groupBy("_h").agg(F.min(id_col).alias("canonical_id"), F.count(F.lit(1)).alias("n_copies"))
    if only_repeated:
        g = g.filter(F.col("n_copies") > 1)
    return h.join(g, "_h").select(id_col, "canonical_id", "n_copies")


# --- DD-2 --------------------------------------------------------------------
def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order_by`` per key (ties: remaining columns)."""
    from ..sinks.writes import latest_per_key
    return latest_per_key(df, keys, order_by)


# --- DD-3 --------------------------------------------------------------------
# Edits allowed as a share of the shorter string: below 1, so a string always
# has more characters than allowed edits and can be cut into edits + 1 parts.
EDIT_SHARE = 0.25
def allowed_edits(length: Column, k: int, share: float = EDIT_SHARE) -> Column:
    """Edits a pair may have whose shorter string has ``length`` characters."""
    return F.least(F.lit(k), F.floor(length * F.lit(share)).cast("int"))


# Multiplier of the segments' polynomial hash, odd and so invertible.
_BASE = 0x9E3779B97F4A7C15


class _Substrings:
    """Hashes of substrings of one text, each in constant time: prefix sums
    of a polynomial in the characters, modulo 2**64. Equal substrings have
    equal hashes; a collision only adds a candidate."""

    _powers = _inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        if len(codes) >= len(self._powers):
            for name, m in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
                x = np.full(2 * len(codes) + 2, m, dtype=np.uint64)
                x[0] = 1
                setattr(_Substrings, name, np.multiply.accumulate(x))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * self._powers[:len(codes)], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        return ((self.sums[start + n] - self.sums[start]) * self._inverses[start]).view(np.int64)


def _segments(length: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the n segments of a string, the first ones one
    character shorter where the length does not divide."""
    size = np.full(n, length // n)
    size[n - length % n:] += 1
    return np.cumsum(size) - size, size


def _edits(length: int, k: int, share: float) -> int:
    return min(k, int(length * share))


#: Strings of one length that may share a segment before finer cuts replace it.
HOT_SEGMENT = 8
#: Finer cuts: characters to a segment, and segments to an edit at most.
FINE_CHARS, FINE_SHARE = 3, 16


def _fine(length: int, edits: int) -> int:
    """Finer segments of a string; fewer than edits + 2 say nothing."""
    return min(max(edits + 2, length // FINE_CHARS), FINE_SHARE * (edits + 2), length)


def _ranges(i: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, place) of every place from lo to hi."""
    count = np.maximum(hi - lo + 1, 0)
    seg = np.repeat(np.arange(len(i)), count)
    return seg, lo[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)


#: Characters are counted in so many classes, modulo 16.
COUNTED_CLASSES = 32


def _sketch(text: str) -> np.ndarray:
    """How often a text has the characters of each class, modulo 16, four bits
    each in two numbers. An edit moves one count by one, or two counts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") % COUNTED_CLASSES
    counts = np.bincount(codes, minlength=COUNTED_CLASSES).astype(np.uint8) & 15
    return (counts[::2] | counts[1::2] << 4).view("<i8")


def _counts_apart(x: Column, y: Column) -> Column:
    """Sum over the 16 counts of two numbers of ``_sketch`` of the least
    steps, up or down modulo 16, from one to the other."""
    low, total = F.lit(0x0F0F0F0F0F0F0F0F), None
    for s in (0, 4):
        a, b = (F.shiftrightunsigned(c, s).bitwiseAND(low) for c in (x, y))
        up = (a.bitwiseOR(F.lit(0x1010101010101010)) - b).bitwiseAND(low)  # modulo 16, in each byte
        far = F.shiftright(up, 3).bitwiseAND(F.lit(0x0101010101010101))  # 1 where it is 8 or more: 16 less that
        steps = up.bitwiseXOR(F.shiftleft(far, 4) - far) + far
        total = steps if total is None else total + steps
    for s, mask in ((8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        total = total.bitwiseAND(F.lit(mask)) + F.shiftrightunsigned(total, s).bitwiseAND(F.lit(mask))
    return total


def _may_be_near(k: int, share: float) -> Column:
    """Of a string (l, c0, c1) and a longer one (d0, d1): their counts do not
    need more edits than allowed."""
    apart = _counts_apart(F.col("c0"), F.col("d0")) + _counts_apart(F.col("c1"), F.col("d1"))
    return apart <= 2 * allowed_edits(F.col("l"), k, share)


class _Cut:
    """How strings are cut: ``fine`` or into one segment more than edits.
    ``have`` counts the strings of each length (up to 2): a probe for a
    length that no other string has finds nothing."""

    def __init__(self, k: int, share: float, fine: bool, have: np.ndarray | None = None):
        self.k, self.share, self.fine, self.have = k, share, fine, have

    def count(self, length: int, edits: int) -> int:
        return _fine(length, edits) if self.fine else edits + 1

    def index(self, text: str) -> tuple[np.ndarray, ...]:
        """(l, i, h): every segment of a text that may have a partner."""
        m, e = len(text), _edits(len(text), self.k, self.share)
        if e < 1:
            return (np.zeros(0, dtype=np.int64),) * 3
        n = self.count(m, e)
        return np.full(n, m), np.arange(n), _Substrings(text).hashes(*_segments(m, n))

    def probes(self, text: str) -> tuple[np.ndarray, ...]:
        """(l, i, h): substrings that could equal segment i of a text of
        length l <= its own, d the difference in length. Of e + 1 segments one
        is intact within [p-i, p+i] and [p+d-(e-i), p+d+(e-i)]; any intact
        segment of a pair within e edits lies in [p-(e-d)/2, p+(e+d)/2]."""
        m = len(text)
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64),) * 3]
        lengths = range(max(1, m - self.k), m + 1)
        if self.have is not None:
            lengths = [l for l in lengths if l >= len(self.have) or self.have[l] > (l == m and not self.fine)]
        if _edits(m, self.k, self.share) >= 1 and len(lengths):
            sub = _Substrings(text)
            for l in lengths:
                e, d = _edits(l, self.k, self.share), m - l
                if e < 1 or d > e:
                    continue
                p, n = _segments(l, self.count(l, e))
                i = np.arange(len(p))
                lo, hi = np.maximum(p - (e - d) // 2, 0), np.minimum(p + (e + d) // 2, m - n)
                if not self.fine:
                    lo, hi = np.maximum.reduce([lo, p - i, p + d - (e - i)]), np.minimum.reduce([hi, p + i, p + d + (e - i)])
                seg, at = _ranges(i, lo, hi)
                out.append((np.full(len(seg), l), seg, sub.hashes(at, n[seg])))
        return tuple(np.concatenate(c) for c in zip(*out))


#: Keys that a task holds at once (a text has some ten thousand at most).
KEYS_AT_ONCE = 1 << 19
#: Bits of a filter: so many for each key of the index, and at most 32 MB.
FILTER_SHARE, FILTER_BITS = 16, 1 << 28


def _places(l: np.ndarray, i: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A number below 2**32 for each key (l, i, h), its upper bits mixed best."""
    x = h.view(np.uint64) ^ (l.astype(np.uint64) << np.uint64(32) | i.astype(np.uint64)) * np.uint64(_BASE)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(32)) * np.uint64(_BASE) >> np.uint64(32)


class _Filter:
    """A bitmap of the places of all keys in an index: a probe whose bit is
    not set finds nothing and need not be shuffled. Filled by Spark's bitmap
    aggregates; the driver and each task hold ``bits / 8`` bytes."""

    def __init__(self, index: DataFrame):
        n = index.count()
        bits = min(max(FILTER_SHARE * n, 1 << 16), FILTER_BITS)
        self.shift = 32 - (bits - 1).bit_length()
        at = F.shiftright("place", self.shift) + 1
        pages = index.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m"))
        bitmap = np.zeros((1 << 32 - self.shift) // 8, dtype=np.uint8)
        for r in pages.collect():  # 4 KB each, FILTER_BITS at most
            m = np.frombuffer(bytes(r["m"]), np.uint8)
            bitmap[(r["page"] - 1) * len(m):r["page"] * len(m)] = m
        self.bitmap = index.sparkSession.sparkContext.broadcast(bitmap)

    def __call__(self, places: np.ndarray) -> np.ndarray:
        at = places >> np.uint64(self.shift)
        return (self.bitmap.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


#: Names of the sketch's numbers in an index and in probes.
SKETCH = {"rid": ("c0", "c1"), "sid": ("d0", "d1")}


def _key_batches(batches, rows, id_name: str, found_in: _Filter | None = None, at_once: int = KEYS_AT_ONCE):
    """Batches of the keys of (id, text) batches, each of ``at_once`` and one text's keys at most."""
    def batch(ids, found, sketches):
        sizes = [len(f[0]) for _, f in found]
        which = np.repeat([j for j, _ in found], sizes).astype(np.int64)
        sketch = np.repeat(np.array(sketches), sizes, axis=0)
        l, i, h = (np.concatenate([f[c] for _, f in found]) for c in range(3))
        at = _places(l, i, h)
        if found_in is not None:
            some = found_in(at)
            l, i, h, which, at, sketch = (x[some] for x in (l, i, h, which, at, sketch))
        return pa.record_batch([pa.array(l, pa.int32()), pa.array(i, pa.int32()), pa.array(h, pa.int64()), ids.take(pa.array(which)), pa.array(at.astype(np.int64)),
                                *(pa.array(np.ascontiguousarray(sketch[:, c])) for c in range(2))],
                               names=["l", "i", "h", id_name, "place", *SKETCH[id_name]])

    for b in batches:
        found, sketches, n = [], [], 0
        for j, text in enumerate(b.column(1)):
            text = text.as_py()
            found.append((j, rows(text)))
            sketches.append(_sketch(text))
            n += len(found[-1][1][0])
            if n >= at_once:
                yield batch(b.column(0), found, sketches)
                found, sketches, n = [], [], 0
        if found:
            yield batch(b.column(0), found, sketches)


def _keys(strings: DataFrame, rows, id_name: str, found_in: _Filter | None = None) -> DataFrame:
    """(l, i, h, id, place, sketch) of every text's segments or probes, in numpy per
    batch: built-in expressions would copy or walk the whole text once per
    probe. ``found_in`` drops keys that an index does not have."""
    schema = T.StructType([T.StructField("l", T.IntegerType()), T.StructField("i", T.IntegerType()), T.StructField("h", T.LongType()),
                           T.StructField(id_name, strings.schema["id"].dataType), T.StructField("place", T.LongType()),
                           *(T.StructField(c, T.LongType()) for c in SKETCH[id_name])])
    return strings.select("id", "t").mapInArrow(lambda batches: _key_batches(batches, rows, id_name, found_in), schema)


#: Lengths that are counted for the probes; longer strings are probed at every length.
COUNTED_LENGTHS = 1 << 20


def _lengths(strings: DataFrame) -> np.ndarray:
    """Strings of each length below COUNTED_LENGTHS, up to 2; a megabyte."""
    have = np.zeros(COUNTED_LENGTHS, dtype=np.uint8)
    for r in strings.filter(F.col("len") < COUNTED_LENGTHS).groupBy("len").count().collect():
        have[r["len"]] = min(r["count"], 2)
    return have


def _candidates(s: DataFrame, k: int, share: float, hot_segment: int = HOT_SEGMENT) -> DataFrame:
    """(rid, sid, l): pairs of strings that may be near, the first not longer, of l characters.

    A string is found by its edits + 1 segments. Where more than
    ``hot_segment`` strings share one (texts of one template), the string is
    found by finer segments instead: of any edits + 2 of them a partner keeps
    two, so the ones that the fewest strings share are taken, and a candidate
    must have two.
    """
    have = _lengths(s)
    index = keep(_keys(s, _Cut(k, share, False).index, "rid"), "dd3-index")
    shared = index.groupBy("l", "i", "h").count().filter(F.col("count") > hot_segment)
    # A string needs edits + 2 characters to be cut finer.
    hot = index.join(shared, ["l", "i", "h"]).filter(F.col("l") >= F.least(F.lit(k), F.floor(F.col("l") * F.lit(share))) + 2).select("rid").distinct()
    hot = keep(hot, "dd3-hot")
    cold = index.join(hot, "rid", "left_anti")
    probes = _keys(s, _Cut(k, share, False, have).probes, "sid", _Filter(cold))
    near = (F.col("rid") != F.col("sid")) & _may_be_near(k, share)
    cand = cold.join(probes, ["l", "i", "h"]).filter(near).select("rid", "sid", "l")
    if not hot.limit(1).count():
        return cand
    of = s.join(hot.select(F.col("rid").alias("id")), "id", "left_semi")
    fine = keep(_keys(of, _Cut(k, share, True).index, "rid"), "dd3-fine")
    n = fine.groupBy("l", "i", "h").count()
    least = F.expr("slice(array_sort(collect_list(struct(count, i, h, place))), 1, cast(min(least(%d, floor(l * %r))) as int) + 2)" % (k, share))
    rare = fine.join(n, ["l", "i", "h"]).groupBy("rid", "l", "c0", "c1").agg(least.alias("rare"))  # FINE_SHARE * (k + 2) segments at most
    rare = keep(rare.select("rid", "l", "c0", "c1", F.explode("rare").alias("x")).select("rid", "l", "c0", "c1", "x.i", "x.h", "x.place"), "dd3-rare")
    probes = _keys(s, _Cut(k, share, True, _lengths(of)).probes, "sid", _Filter(rare))
    both = rare.join(probes, ["l", "i", "h"]).filter(near).select("rid", "sid", "l", "i").distinct()
    return cand.unionByName(both.groupBy("rid", "sid", "l").count().filter("count > 1").select("rid", "sid", "l"))


def _spread(df: DataFrame) -> DataFrame:
    """A table estimated to fill fewer scan tasks than the cluster has cores, dealt over all cores."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if size < cores * (128 << 20) else df


#: Ids that are broadcast; more of them are joined by shuffles.
MANY_IDS = 1 << 20
#: Characters that a round of verifications moves at least.
ROUND_CHARS = 1 << 28


def _few(ids: DataFrame) -> DataFrame | None:
    """``ids``, broadcast, if there are few."""
    return F.broadcast(ids) if ids.count() <= MANY_IDS else None


def _verified(pairs: DataFrame, s: DataFrame, k: int, share: float, round_chars: int = ROUND_CHARS) -> DataFrame:
    """(id_a, id_b, distance) of the pairs (a, b, l) that are near. Each pair
    carries a text to the other one, so pairs are taken in rounds of about
    the text there is, and a round's shuffle files go before the next."""
    chars = pairs.agg(F.sum(F.col("l").cast("long"))).first()[0] or 0
    have = s.agg(F.sum(F.col("len").cast("long"))).first()[0] or 0
    rounds = max(1, -(-chars // max(have, round_chars)))
    ids = _few(keep(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "dd3-ids"))
    texts = s if ids is None else s.join(ids, "id", "left_semi")
    ta = texts.select(F.col("id").alias("a"), F.col("t").alias("ta"), F.col("len").alias("la"))
    tb = texts.select(F.col("id").alias("b"), F.col("t").alias("tb"), F.col("len").alias("lb"))
    out = []
    for r in range(rounds):
        some = pairs.filter(F.pmod(F.xxhash64("a"), F.lit(rounds)) == r) if rounds > 1 else pairs
        v = some.select("a", "b").join(ta, "a").join(tb, "b").select(
            "a", "b", F.levenshtein("ta", "tb", k).alias("distance"), allowed_edits(F.least("la", "lb"), k, share).alias("e"))
        v = v.filter((F.col("distance") >= 0) & (F.col("distance") <= F.col("e"))).select(
            F.col("a").alias("id_a"), F.col("b").alias("id_b"), F.col("distance").cast("int").alias("distance"))
        out.append(keep(v, "dd3-links"))
    return reduce(DataFrame.unionByName, out)


def lev_pairs(df: DataFrame, id_col: str, text: Column, k: int, share: float = EDIT_SHARE, hot_segment: int = HOT_SEGMENT) -> DataFrame:
    """All links between near strings: (id_a, id_b, distance), id_a < id_b.

    Equal strings are one node, named by their smallest id; each copy is
    linked to that id at distance 0. Different strings are linked, by those
    ids, when their distance is at most ``k`` and at most ``share`` of the
    shorter one's length. Empty strings say nothing and link with nothing.
    """
    with shuffles_freed(df.sparkSession):
        x = keep(_spread(df).select(F.col(id_col).alias("id"), text.alias("t")).filter(F.length("t") > 0)
                  .select("id", "t", F.length("t").alias("len"), F.xxhash64("t").alias("h1"), F.sha2("t", 256).alias("h2")), "dd3-texts")
        first = keep(x.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "dd3-first")
        named = x.select("id", "h1", "h2").join(first.filter("n > 1"), ["h1", "h2"]).select("id", "first")
        copies = named.filter(F.col("id") != F.col("first")).select(
            F.col("first").alias("id_a"), F.col("id").alias("id_b"), F.lit(0).alias("distance"))
        ids = first.select(F.col("first").alias("id"))
        # Few ids that name no string are passed over wherever the texts are read, so these are neither moved nor written again.
        others = _few(keep(x.select("id").filter("id is not null").join(ids, "id", "left_anti").distinct(), "dd3-others"))
        s = x.select("id", "t", "len")
        s = keep(s.join(ids, "id", "left_semi"), "dd3-strings") if others is None else s.filter("id is not null").join(others, "id", "left_anti")
        cand = _candidates(s, k, share, hot_segment)
        pairs = keep(cand.groupBy(F.least("rid", "sid").alias("a"), F.greatest("rid", "sid").alias("b")).agg(F.max("l").alias("l")), "dd3-pairs")
        return _verified(pairs, s, k, share).unionByName(copies)


# --- DD-4 --------------------------------------------------------------------
def _sym(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            .filter(F.col("u") != F.col("v")).distinct()


def _large_star(e: DataFrame) -> DataFrame:
    s = _sym(e)
    m = s.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return s.filter(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter(F.col("u") != F.col("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    s = _sym(e).filter(F.col("v") < F.col("u"))
    m = s.groupBy("u").agg(F.min("v").alias("m"))
    j = s.join(m, "u")
    moved = j.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = m.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 100) -> DataFrame:
    """(node, cluster): cluster = smallest node id in the connected component.

    ``edges`` has columns (u, v); ``nodes`` (column ``node``) adds isolated
    vertices. Each round (large-star then small-star) is checkpointed to the
    shared folder; the loop stops when a round leaves the edge set unchanged.
    Degree aggregates are partial (min), so a hub is combined map-side.
    ``max_rounds`` guards against endless loops: the rounds needed grow with
    the logarithm of the data, and running out raises, it drops nothing.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
    e = e.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
         .distinct()
    with shuffles_freed(edges.sparkSession):
        e = e.checkpoint(eager=True)
    n_e = e.count()
    for _ in range(max_rounds):
        with shuffles_freed(edges.sparkSession):
            nxt = _small_star(_large_star(e)).checkpoint(eager=True)
        n_nxt = nxt.count()
        # Both sets are distinct: equal sizes and nothing new means equal.
        same = n_nxt == n_e and nxt.join(e, ["u", "v"], "left_anti").limit(1).count() == 0
        e, n_e = nxt, n_nxt
        if same:
            break
    else:
        raise RuntimeError("components did not converge")
    # At convergence every edge points from a node to its component minimum.
    lab = _sym(e).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("cluster")) \
                 .select(F.col("u").alias("node"), "cluster")
    if nodes is not None:
        all_nodes = nodes.select(F.col("node").cast("bigint").alias("node")).distinct()
        lab = all_nodes.join(lab, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster"))
    return lab


def update_components(labels: DataFrame, new_edges: DataFrame, new_nodes: DataFrame | None = None) -> DataFrame:
    """(node, cluster) after a batch of edges, from the clusters before it.

    Old clusters are single nodes of a contracted graph, named by their
    labels, which are their smallest members; only the batch's edges are
    traversed. The result is that of ``components`` over all edges. A label
    moves only where a batch joins clusters, so most rows pass through one
    join with the few labels that moved.
    """
    old = labels.select(F.col("node").cast("bigint").alias("node"), F.col("cluster").cast("bigint").alias("cluster"))
    e = new_edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
    ends = e.select(F.col("u").alias("node")).unionByName(e.select(F.col("v").alias("node")))
    if new_nodes is not None:
        ends = ends.unionByName(new_nodes.select(F.col("node").cast("bigint").alias("node")))
    unseen = ends.distinct().join(old.select("node"), "node", "left_anti")
    every = keep(old.unionByName(unseen.select("node", F.col("node").alias("cluster"))), "dd4-labels")
    c = e.join(every.toDF("u", "cu"), "u").join(every.toDF("v", "cv"), "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    moved = components(c).filter(F.col("node") != F.col("cluster")).toDF("cluster", "moved")
    return every.join(moved, "cluster", "left").select("node", F.coalesce("moved", "cluster").alias("cluster"))


# --- DD-5 --------------------------------------------------------------------
def survivor(df: DataFrame, cluster_col: str, rules: dict[str, Column]) -> DataFrame:
    """One golden row per cluster; ``rules`` maps output column to an
    aggregate (``max_by``, ``min_by``, ``max`` ...), all combined map-side."""
    return df.groupBy(cluster_col).agg(*[c.alias(n) for n, c in rules.items()])
