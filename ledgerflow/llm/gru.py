"""Gated recurrent language model: training and document log-likelihoods.

Tokens are words ``[^\x20\x09-\x0D]+`` after folding A-Z, then one end per
document. Training rows are those whose crc32(id as text) mod ``folds`` is
not 0; their word counts also give the unigram base score.

Output. Words fall into classes by their last two bytes (the endings with
most tokens; ``OTHERS`` classes for all others, by the last byte, so that none is
much larger than the rest; one for the end). The next token's
probability is p(class | state) * p(slot | class, state) * p(word | slot):
both softmaxes are computed from the recurrent state. A slot is a frequent
word, or the class's rest, within which words go by their counts, with the
share of words seen once (Good-Turing) kept for unseen words. All words of
all training rows are counted; the frequent ones (``MODEL_WORDS``) have
slots of their own.

Training. Truncated backpropagation in numpy: a part's documents are laid end
to end in up to ``LANES`` lanes (fewer where that gives less than ``STEPS``
steps) and gone through in windows of ``WINDOW`` tokens, carrying the state from window to window and clearing it at a document's
start. Every training row takes part once, in one of ``ROUNDS`` rounds; a
round starts all parts from the same parameters and averages what they
return, weighted by tokens. The parameters (some 28,000 numbers, set by the
constants below, not by the data) are summed by index in a shuffle, as whole
multiples of 1/``GRAIN``, so that the order of addition changes nothing.

Parts. Texts are turned into slot numbers once (two bytes a token) and
stored; training and scoring read these. Training rows are dealt to parts
of about ``PART_TOKENS`` tokens by a hash of id and slots, and sorted within a part, so
the parameters depend on the rows, not on files, partitions or executors.

Scoring. Documents are dealt to lanes whole and state is carried across all
windows of a document, so a score is the log10 probability of the complete
text however long it is. The ``DICTIONARY`` most frequent words travel with
the tasks (a bounded size); words beyond them are joined to the counts by a
shuffle, so no word loses its count.

Nulls and odd rows: a null text is the empty text (one end); a null id
counts as an empty id text; repeated rows are scored, and counted, once per
row; without training rows all words are unseen; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_bucket, split_words, stored, text_or_empty

FOLDS = 10
CLASSES, OTHERS = 32, 16
MODEL_WORDS = 1000
DICTIONARY = 200_000
EMBED = HIDDEN = 12
LANES, WINDOW, STEPS = 512, 16, 100
ROUNDS = 2
RATE = 0.03
SMOOTH = 0.1
SEED = 2
PART_TOKENS = 4_000_000
GRAIN = 1 << 14
#: Tokens laid out at once in training and in scoring, and counted together;
#: words in a batch of counts.
HELD_TOKENS, SCORED_TOKENS, COUNTED_TOKENS = 2_000_000, 8_000_000, 2_000_000
COUNTED_ROWS = 50_000
SCORE_LANES, SCORE_WINDOW = 1024, 16
#: Tokens whose probabilities are computed together when scoring.
OUTPUT_ROWS = 16_384


#: Stands for the end of a text; no byte of UTF-8.
END = b"\xff"
#: A-Z folded, white space to blanks.
_FOLD_BYTES = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)), np.uint8)


class Vocabulary:
    """Dictionary words with slots and counts, classes, and what is needed to
    score words beyond the dictionary; its size is bounded by constants."""

    def __init__(self, words: list[str], counts: np.ndarray, endings: list[bytes], masses: np.ndarray, kinds: np.ndarray, once: np.ndarray,
                 end_count: int, tokens: int, distinct: int):
        """``endings`` are the classes after the end's; ``masses``, ``kinds``
        and ``once`` are tokens, words and words seen once per class (the
        endings', then those of all others)."""
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = np.asarray(counts, dtype=np.int64)[order]
        self.tokens, self.distinct, self.end_count = tokens, distinct, end_count
        self.class_of_ending = {e: i + 1 for i, e in enumerate(endings)}
        self.others, self.first_other = len(masses) - len(endings), len(endings) + 1
        self.ending_class = (self.first_other + np.arange(1 << 16) % 256 % self.others).astype(np.int32)  # by last byte but one, last byte
        for e, k in self.class_of_ending.items():
            self.ending_class[int.from_bytes(e, "big")] = k
        n_classes = self.first_other + self.others
        word_class = np.array([self.class_of(w.encode()) for w in self.words], dtype=np.int64)
        own = np.zeros(len(self.words), dtype=bool)
        own[:MODEL_WORDS] = True
        sizes = np.bincount(word_class[own], minlength=n_classes) + 1  # and the rest
        sizes[0] = 1
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.rest = self.first[1:] - 1
        self.slot_class = np.repeat(np.arange(n_classes), sizes)
        self.slots = self.rest[word_class]
        for k in range(1, n_classes):
            mine = np.flatnonzero(own & (word_class == k))
            self.slots[mine] = self.first[k] + np.arange(len(mine))
        mass = np.zeros(len(self.slot_class))
        mass[0] = end_count
        rest_mass = np.concatenate([[0], masses]).astype(float)
        rest_once = np.concatenate([[0], once]).astype(float)
        np.subtract.at(rest_mass, word_class[own], self.counts[own])
        np.subtract.at(rest_once, word_class[own], (self.counts[own] == 1).astype(float))
        mass[self.slots[own]] = self.counts[own]
        mass[self.rest[1:]] = rest_mass[1:]
        self.unseen = (rest_once + 0.5) / (rest_mass + 1.0)  # per class, within its rest
        self.rest_mass = np.maximum(rest_mass, 1.0)
        share = (mass + 0.5) / (mass + 0.5).sum()
        self.slot_bias = np.log(share).astype(np.float32)
        self.class_bias = np.log(np.bincount(self.slot_class, weights=share)).astype(np.float32)
        self.slot_bias -= self.class_bias[self.slot_class]
        self.base_norm = tokens + SMOOTH * (distinct + 1)
        self.base = np.log10((self.counts + SMOOTH) / self.base_norm)
        self.base_end = float(np.log10((end_count + SMOOTH) / self.base_norm))
        self.within = np.where(own, 0.0, np.log10((1 - self.unseen[word_class]) * self.counts / self.rest_mass[word_class]))
        self._index: dict[bytes, int] | None = None

    def class_of(self, word: bytes) -> int:
        known = self.class_of_ending.get(word[-2:])
        return self.first_other + word[-1] % self.others if known is None else known

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None, "words": "\n".join(self.words)}

    def __setstate__(self, d: dict) -> None:
        self.__dict__.update(d)
        self.words = d["words"].split("\n") if d["words"] else []

    def encode(self, texts: pa.Array) -> "Encoded":
        """All texts of an array: each word that occurs is looked up once."""
        if self._index is None:
            self._index = {w.encode(): i for i, w in enumerate(self.words)}
        coded = split_words(texts, _FOLD_BYTES, END, False).dictionary_encode()
        which, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        at = np.fromiter(map(self._index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        known = at >= 0
        slots = np.where(known, self.slots[at], 0).astype(np.uint16) if len(self.words) else np.zeros(len(words), np.uint16)
        base, within = (np.where(known, x[at], 0.0) if len(self.words) else np.zeros(len(words)) for x in (self.base, self.within))
        beyond = np.flatnonzero(~known).tolist()
        end = next((i for i in beyond if words[i] == END), 0)
        for i in beyond:
            slots[i] = 0 if i == end else self.rest[self.class_of(words[i])]
        tail = ~known
        if len(words):
            base[end], known[end], tail[end] = self.base_end, self.end_count > 0, False
        stops = np.flatnonzero(which == end) + 1 if len(words) else np.zeros(0, np.int64)
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        total = lambda x: np.add.reduceat(x[which], starts) if len(starts) else np.zeros(0)
        # The words beyond the dictionary, few, by text.
        far = np.flatnonzero(tail[which])
        cuts = np.searchsorted(far, np.concatenate([starts, stops[-1:]]))
        far = [words[i].decode() for i in which[far].tolist()]
        return Encoded(slots[which], starts, stops, total(known.astype(np.int64)), total(base), total(within), [far[i:j] for i, j in zip(cuts[:-1], cuts[1:])])


class Encoded(NamedTuple):
    """Texts in sequence: text i has ``slots[starts[i]:stops[i]]``, its end
    last, and one entry in each of the rest."""
    slots: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    known: np.ndarray
    base: np.ndarray
    within: np.ndarray
    tails: list[list[str]]

    def of(self, i: int) -> np.ndarray:
        return self.slots[self.starts[i]:self.stops[i]]


_ONES = np.ones(4096, dtype=np.float32)


def _log_softmax(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray, slopes: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probabilities of the chosen columns and, with ``slopes``,
    the derivative of their negative by the logits. Logits are log shares
    and what training adds, far below where exp overflows; if they ever were
    not, the rows' largest are taken off first. Overwrites ``logits``."""
    ones = _ONES[:logits.shape[1]] if logits.shape[1] <= len(_ONES) else np.ones(logits.shape[1], dtype=np.float32)
    picked = logits[rows, chosen]
    e = np.exp(logits)
    total = e @ ones
    if not 0 < total.min() <= total.max() < np.inf:
        logits = logits - logits.max(axis=1, keepdims=True)
        picked = logits[rows, chosen]
        e = np.exp(logits)
        total = e @ ones
    logp = picked - np.log(total)
    if not slopes:
        return logp, None
    e *= (1 / total)[:, None]
    e[rows, chosen] -= 1
    return logp, e


class Network:
    """Parameters as views into one flat vector, and the passes over them."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        v = vocabulary
        self.n_slots, self.n_classes = len(v.slot_class), len(v.first) - 1
        self.first, self.slot_class = v.first, v.slot_class
        s, c, e, h = self.n_slots, self.n_classes, EMBED, HIDDEN
        self.shapes = {"emb": (s + 1, e), "w": (e, 3 * h), "u": (h, 3 * h), "b": (3 * h,), "wc": (h, c), "bc": (c,), "ws": (s, h), "bs": (s,)}
        self.size = sum(int(np.prod(x)) for x in self.shapes.values())
        if flat is None:
            rng = np.random.default_rng(SEED)
            flat = (rng.standard_normal(self.size) * 0.1).astype(np.float32)
            self.flat = flat
            self.__dict__.update(self.views(flat))
            self.u *= 3.0
            self.w *= 3.0
            self.wc *= 0.1
            self.ws *= 0.1
            self.b[:] = 0
            self.bc[:] = v.class_bias
            self.bs[:] = v.slot_bias
        self.flat = np.array(flat, dtype=np.float32)
        self.__dict__.update(self.views(self.flat))

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[k] = flat[at:at + n].reshape(shape)
            at += n
        return out

    def recur(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States over a window (T, B) of input slots; ``fresh`` marks where
        a document starts. ``keep`` gets what the way back needs."""
        n = HIDDEN
        proj = (self.emb[x] @ self.w + self.b)
        out = np.empty((*x.shape, n), dtype=np.float32)
        any_fresh = fresh.any(axis=1)
        for t in range(len(x)):
            if any_fresh[t]:
                h = np.where(fresh[t][:, None], np.float32(0), h)
            hu = h @ self.u
            p = proj[t]
            gates = p[:, :2 * n] + hu[:, :2 * n]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :n], gates[:, n:]
            cand = r * hu[:, 2 * n:]
            cand += p[:, 2 * n:]
            np.tanh(cand, out=cand)
            new = out[t]
            np.subtract(h, cand, out=new)
            new *= z
            new += cand
            if keep is not None:
                keep.append((h, z, r, cand, hu[:, 2 * n:]))
            h = new
        return out, h

    def outputs(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of target slots from states (N, H); with
        ``grads``, adds the heads' gradients and returns that of the states."""
        k = self.slot_class[target].astype(np.int16)  # sorted by radix
        # Rows in the order of their classes: a class is a slice of them.
        order = np.argsort(k, kind="stable")
        bounds = np.searchsorted(k[order], np.arange(self.n_classes + 1))
        hs, ks, ts = h[order], k[order], target[order]
        rows = np.arange(len(h))
        logp, d = _log_softmax(hs @ self.wc + self.bc, rows, ks, grads is not None)
        logp = logp.astype(np.float64)
        dhs = None
        if grads is not None:
            grads["wc"] += hs.T @ d
            grads["bc"] += d.sum(axis=0)
            dhs = d @ self.wc.T
        for c in range(self.n_classes):
            i, j = bounds[c], bounds[c + 1]
            a, b = self.first[c], self.first[c + 1]
            if i == j or b - a == 1:
                continue
            hc = hs[i:j]
            part, d = _log_softmax(hc @ self.ws[a:b].T + self.bs[a:b], rows[:j - i], ts[i:j] - a, grads is not None)
            logp[i:j] += part
            if grads is not None:
                grads["ws"][a:b] += d.T @ hc
                grads["bs"][a:b] += d.sum(axis=0)
                dhs[i:j] += d @ self.ws[a:b]
        back = np.empty_like(order)
        back[order] = rows
        return logp[back], None if dhs is None else dhs[back]

    def gradient(self, x: np.ndarray, target: np.ndarray, fresh: np.ndarray, weight: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(gradient, state after the window, log probability) of a window,
        truncated at its start. ``weight`` is 0 at padding."""
        n = HIDDEN
        flat = np.zeros(self.size, dtype=np.float32)
        g = self.views(flat)
        keep: list = []
        states, last = self.recur(x, fresh, h, keep)
        flat_states = states.reshape(-1, n)
        live = weight.ravel() > 0
        if live.all():
            logp, dh = self.outputs(flat_states, target.ravel(), g)
        else:
            logp, part = self.outputs(flat_states[live], target.ravel()[live], g)
            dh = np.zeros_like(flat_states)
            dh[live] = part
        dh = dh.reshape(states.shape)
        h0, z, r, cand, hun = (np.stack(v) for v in zip(*keep))
        # All that doesn't wait for the way back, for the whole window at once.
        to_cand, to_z = (1 - z) * (1 - cand * cand), (h0 - cand) * z * (1 - z)
        to_r = hun * r * (1 - r)
        dproj = np.empty((*x.shape, 3 * n), dtype=np.float32)
        dhu = np.empty_like(dproj)
        back = np.zeros_like(h)
        any_fresh = fresh.any(axis=1)
        ut = np.ascontiguousarray(self.u.T)
        for t in range(len(x) - 1, -1, -1):
            d = dh[t] + back
            p = dproj[t]
            dc = np.multiply(d, to_cand[t], out=p[:, 2 * n:])
            np.multiply(d, to_z[t], out=p[:, :n])
            np.multiply(dc, to_r[t], out=p[:, n:2 * n])
            q = dhu[t]
            q[:, :2 * n] = p[:, :2 * n]
            np.multiply(dc, r[t], out=q[:, 2 * n:])
            back = q @ ut
            d *= z[t]
            back += d
            if any_fresh[t]:
                back[fresh[t]] = 0
        dp = dproj.reshape(-1, 3 * n)
        inputs = x.ravel()
        g["u"] += h0.reshape(-1, n).T @ dhu.reshape(-1, 3 * n)
        g["w"] += self.emb[inputs].T @ dp
        g["b"] += dp.sum(axis=0)
        de = dp @ self.w.T
        order = np.argsort(inputs, kind="stable")
        starts = np.flatnonzero(np.diff(inputs[order], prepend=-1))
        g["emb"][inputs[order][starts]] = np.add.reduceat(de[order], starts, axis=0)
        return flat / max(len(logp), 1), last, float(logp.sum())


class Adam:
    def __init__(self, size: int, rate: float = RATE):
        self.m, self.v, self.t, self.rate = np.zeros(size, np.float32), np.zeros(size, np.float32), 0, rate

    def step(self, flat: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        scale = self.rate / np.sqrt(1 + self.t / 100) * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        flat -= np.float32(scale) * self.m / (np.sqrt(self.v) + np.float32(1e-8))


def train_on(net: Network, documents: Iterator[np.ndarray], start: int) -> tuple[int, float]:
    """Windows over documents (slot arrays) laid end to end in lanes; returns
    tokens and their log probability. ``start`` is the input before a
    document's first token."""
    adam, tokens, total = Adam(net.size), 0, 0.0
    held: list[np.ndarray] = []
    n = 0

    def go(parts: list[np.ndarray]) -> None:
        nonlocal tokens, total
        target = np.concatenate(parts)
        fresh = np.zeros(len(target), dtype=bool)
        fresh[np.cumsum([0, *(len(p) for p in parts[:-1])])] = True
        x = np.concatenate([[start], target[:-1]]).astype(np.int32)
        x[fresh] = start
        lanes = min(LANES, max(1, len(target) // (WINDOW * STEPS)))
        steps = -(-len(target) // lanes)
        pad = lanes * steps - len(target)
        lay = lambda a, fill: np.concatenate([a, np.full(pad, fill, a.dtype)]).reshape(lanes, steps).T
        x, y, f, w = lay(x, start), lay(target, 0), lay(fresh, True), lay(np.ones(len(target), np.float32), 0)
        h = np.zeros((lanes, HIDDEN), dtype=np.float32)
        for t in range(0, steps, WINDOW):
            s = slice(t, t + WINDOW)
            grad, h, logp = net.gradient(x[s], y[s], f[s], w[s], h)
            adam.step(net.flat, grad)
            total += logp
        tokens += len(target)
    for d in documents:
        held.append(d)
        n += len(d)
        if n >= HELD_TOKENS:
            go(held)
            held, n = [], 0
    if held:
        go(held)
    return tokens, total


def log10_of(net: Network, documents: list[np.ndarray], start: int) -> np.ndarray:
    """log10 probability of each document's slots, states carried from its
    first token to its last. Documents are dealt whole to lanes, the longest
    first to the lane with least; each lane's documents follow each other."""
    import heapq
    lanes: list[list[int]] = [[] for _ in range(min(SCORE_LANES, len(documents)))]
    load = [(0, i) for i in range(len(lanes))]
    for d in sorted(range(len(documents)), key=lambda d: -len(documents[d])):
        n, i = heapq.heappop(load)
        lanes[i].append(d)
        heapq.heappush(load, (n + len(documents[d]), i))
    loads = [0] * len(lanes)
    for n, i in load:
        loads[i] = n
    lanes = [lanes[i] for i in sorted(range(len(lanes)), key=lambda i: -loads[i])]
    dealt = [d for own in lanes for d in own]
    if not dealt:
        return np.zeros(0)
    y = np.concatenate([documents[d] for d in dealt])
    sizes = np.array([len(documents[d]) for d in dealt])
    doc = np.repeat(np.array(dealt, dtype=np.int32), sizes)
    fresh = np.zeros(len(y), dtype=bool)
    fresh[np.cumsum(sizes) - sizes] = True
    x = np.empty(len(y), np.int32)
    x[1:] = y[:-1]
    x[fresh] = start
    length = np.array(sorted(loads, reverse=True))
    first = np.cumsum(length) - length
    out = np.zeros(len(documents))
    h = np.zeros((len(lanes), HIDDEN), dtype=np.float32)
    held: list[tuple[np.ndarray, np.ndarray]] = []  # states and the places they predict
    waiting = 0

    def flush() -> None:
        at = np.concatenate([p for _, p in held])
        logp, _ = net.outputs(np.concatenate([s for s, _ in held]), y[at])
        out[:] += np.bincount(doc[at], weights=logp, minlength=len(documents))
        held.clear()
    for t in range(0, int(length[0]), SCORE_WINDOW):
        live = int(np.searchsorted(-length, -t, "left"))  # lanes longer than t come first
        step = t + np.arange(min(SCORE_WINDOW, int(length[0]) - t))[:, None]
        inside = step < length[:live]
        at = first[:live] + np.minimum(step, length[:live] - 1)
        states, last = net.recur(x[at], fresh[at] & inside, h[:live])
        h[:live] = last
        held.append((states[inside], at[inside]))
        waiting += len(held[-1][1])
        if waiting >= OUTPUT_ROWS:
            flush()
            waiting = 0
    if held:
        flush()
    return out / np.log(10)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Array] = []

    def flush() -> Iterator[pa.RecordBatch]:
        found = pa.concat_arrays(held).dictionary_encode() if held else pa.array([], pa.binary()).dictionary_encode()
        held.clear()
        words, n = found.dictionary, np.bincount(found.indices.to_numpy(zero_copy_only=False), minlength=len(found.dictionary))
        for i in range(0, len(words), COUNTED_ROWS):
            cut = words.slice(i, COUNTED_ROWS)
            some = pc.not_equal(cut, pa.scalar(END, pa.binary()))
            yield pa.record_batch([cut.filter(some).cast(pa.string()), pa.array(n[i:i + COUNTED_ROWS]).filter(some)], names=["word", "n"])
    tokens = 0
    for b in batches:
        held.append(split_words(b.column(b.schema.get_field_index("text")), _FOLD_BYTES, END, False))
        tokens += len(held[-1])
        if tokens >= COUNTED_TOKENS:
            yield from flush()
            tokens = 0
    yield from flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``texts``, added up in each task first."""
    return texts.mapInArrow(_counter, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _ending() -> Column:
    """Last two bytes of column ``word``, as hex digits."""
    return F.hex(F.substring(F.encode("word", "UTF-8"), -2, 2))


def _ending_class(endings: list[bytes], others: int) -> Column:
    """Class of column ``word`` as ``Vocabulary.class_of`` has it."""
    other = F.lit(len(endings) + 1) + F.pmod(F.conv(F.right(_ending(), F.lit(2)), 16, 10).cast("int"), F.lit(others))
    if not endings:
        return other
    m = F.create_map(*(F.lit(x) for i, e in enumerate(endings) for x in (e.hex().upper(), i + 1)))
    return F.coalesce(F.try_element_at(m, _ending()), other)


def build_vocabulary(counts: DataFrame, end_count: int) -> Vocabulary:
    """From the stored word counts; what comes to the driver is bounded by
    ``DICTIONARY`` words and ``CLASSES`` classes."""
    band = F.floor(F.log2("c") * 16)  # a few hundred bands at most
    bands = counts.groupBy(band.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
    distinct, tokens, least, room = sum(r["n"] for r in bands), sum(r["c"] for r in bands), None, DICTIONARY
    for r in sorted(bands, key=lambda r: -r["b"]):
        if r["n"] > room:
            break
        room, least = room - r["n"], r["b"]
    frequent = counts.filter(band >= least) if least is not None else counts.limit(0)
    table = frequent.select("word", "c").toArrow()
    ends = counts.groupBy(_ending().alias("e")).agg(F.sum("c").alias("c"))
    endings = [bytes.fromhex(r["e"]) for r in ends.orderBy(F.col("c").desc(), "e").limit(CLASSES - 2).collect()]
    per = counts.groupBy(_ending_class(endings, OTHERS).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("o"))
    stats = np.zeros((3, len(endings) + OTHERS))
    for r in per.collect():
        stats[:, r["k"] - 1] = r["c"], r["v"], r["o"]
    return Vocabulary(table.column("word").to_pylist(), table.column("c").to_numpy(), endings, *stats,
                      end_count, tokens + end_count, distinct + (end_count > 0))


def _trainer(vocabulary: Vocabulary, flat: np.ndarray) -> Callable:
    """Trains on each part of a partition sorted by part, apart from the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((g, np.frombuffer(s, "<u2")) for b in batches for g, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for _, own in groupby(rows, key=lambda r: r[0]):
            net = Network(vocabulary, flat)
            tokens, logp = train_on(net, (s for _, s in own), net.n_slots)
            values = np.append(net.flat.astype(np.float64) * tokens, [tokens, logp])  # the last two: tokens and their log probability
            yield pa.record_batch([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(np.rint(values * GRAIN).astype(np.int64))], names=["i", "v"])
    return run


def train(encoded: DataFrame, vocabulary: Vocabulary, tokens: int, rounds: int = ROUNDS) -> tuple[np.ndarray, list[float]]:
    """(parameters, mean log10 probability of a slot in each round) from the
    stored training rows of ``encode`` (doc_id, slots), which have ``tokens`` slots."""
    flat, seen = Network(vocabulary).flat, []
    parts = max(1, -(-tokens // (rounds * PART_TOKENS)))
    h = F.xxhash64("doc_id", "slots", F.lit(SEED))
    dealt = encoded.select("slots", h.alias("h"), F.pmod(h, F.lit(rounds)).alias("part"), F.pmod(F.shiftright(h, 16), F.lit(parts)).alias("g"))
    for k in range(rounds):
        x = dealt.filter(F.col("part") == k).select("g", "h", "slots").repartitionById(parts, F.col("g").cast("int")).sortWithinPartitions("g", "h", "slots").select("g", "slots")
        x = x.mapInArrow(_trainer(vocabulary, flat), "i int, v long")
        sums = x.groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).cast("double").alias("v")).toArrow()  # one row per parameter
        if not sums.num_rows:
            continue
        v = np.zeros(len(flat) + 2)
        v[sums.column("i").to_numpy()] = sums.column("v").to_numpy()
        flat = (v[:-2] / v[-2]).astype(np.float32)
        seen.append(float(v[-1] / v[-2] / np.log(10)))
    return flat, seen


def encode(x: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each row of (doc_id, held_out, text) as slots, with what follows from
    counts alone: known tokens, base score, log10 within slots, and the words
    beyond the dictionary."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("slots", pa.binary()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                        ("base", pa.float64()), ("within", pa.float64()), ("tail", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = vocabulary.encode(b.column(2))
            at = np.append(e.starts, e.stops[-1:]).astype(np.int32) * 2 if b.num_rows else np.zeros(1, np.int32)
            slots = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(at), pa.py_buffer(e.slots.astype("<u2"))])
            yield pa.record_batch([b.column(0), b.column(1), slots, *(pa.array(c, f.type) for c, f in zip(
                (e.stops - e.starts, e.known, e.base, e.within, e.tails), list(schema)[3:]))], schema=schema)
    kinds = "doc_id long, held_out boolean, slots binary, n_tokens long, known long, base double, within double, tail array<string>"
    return x.select("doc_id", "held_out", "text").mapInArrow(run, kinds)


def _scorer(vocabulary: Vocabulary, flat: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(vocabulary, flat)
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            at = held[0].schema.get_field_index("slots")
            logp = log10_of(net, [np.frombuffer(s, "<u2") for b in held for s in b.column(at).to_pylist()], net.n_slots)
            done = 0
            for b in held:
                yield pa.record_batch([pa.array(logp[done:done + b.num_rows]), *(c for i, c in enumerate(b.columns) if i != at)],
                                      names=["model", *(f for f in b.schema.names if f != "slots")])
                done += b.num_rows
        for b in batches:
            held.append(b)
            n += b.column(b.schema.get_field_index("slots")).nbytes // 2
            if n >= SCORED_TOKENS:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), (id_bucket(id_col, folds) == 0).alias("held_out"))
    learn = x.filter("not held_out")
    counts = stored(word_counts(learn.select("text")), "word-counts")
    v = build_vocabulary(counts, learn.count())
    encoded = stored(encode(x, v).withColumn("row", F.monotonically_increasing_id()), "lm-slots")
    flat, _ = train(encoded.filter("not held_out").select("doc_id", "slots"), v, v.tokens, rounds)
    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "within", "slots").mapInArrow(
        _scorer(v, flat), "model double, row long, doc_id long, held_out boolean, n_tokens long, known long, base double, within double")
    # Words beyond the dictionary: their counts by a join, their classes' rests as in Vocabulary.
    rest = F.create_map(*(F.lit(y) for k in range(1, len(v.rest)) for y in (k, F.struct(F.lit(float(v.unseen[k])).alias("u"), F.lit(float(v.rest_mass[k])).alias("m")))))
    tail = encoded.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    r = F.try_element_at(rest, _ending_class(list(v.class_of_ending), v.others))
    inner = F.when(F.col("c").isNull(), F.log10(r["u"])).otherwise(F.log10((1 - r["u"]) * F.col("c") / r["m"]))
    tail = tail.select("row", F.col("c").isNotNull().cast("long").alias("k"), inner.alias("i"),
                       F.log10((F.coalesce("c", F.lit(0)) + SMOOTH) / v.base_norm).alias("b"))
    tail = tail.groupBy("row").agg(F.sum("k").alias("k"), F.sum("i").alias("i"), F.sum("b").alias("b"))
    zero = F.lit(0.0)
    return scored.join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"), (F.col("model") + F.col("within") + F.coalesce("i", zero)).alias("score"))
