"""LM scoring (operator 9): logistic context mixing.

Tokens are the lower-cased (A-Z) white-space words of a text and one end.  Three experts share every token:

* the bit mixer: the token's bytes, bit by bit, most significant first, ended by a space.  For every bit of every token of
  the text, predictors hashed from the byte so far and the last 0, 1, 2, 3 or 5 bytes of the word, or the word so far and the
  word before it, give logits from their counts; a mixer adds them with weights chosen by a gate (how many of the predictors
  know their context), learnt online by gradient steps on the coding cost over all training tokens; and an adaptive map by
  gate and quantised logit refines the mixed probability;
* vocabulary: the word's discounted count in the documents of the text's class, backing off to its count in all training
  documents and then to the bit mixer.  Classes are the components of a mixture of ``CLASSES`` multinomials over hashed
  words, fitted to all training documents; naming a text's class costs it ``log10(CLASSES)`` once;
* the text itself: the words already seen in it.

A gate per text shares a token among the three; it is refined online after each block of tokens.  The sum is the text's
probability, in log10 and in bits per byte.

Everything counted covers every token of every training document (``crc32(doc_id as text) mod 5`` other than 1).  Word counts
are exact and grow with the corpus; they are joined with the distinct words of each block of documents, never broadcast.  The
bit predictors live in ``len(CONTEXTS) * SLOTS`` pairs of counters of fixed size (a documented parameter, about 25 MB), which
is what is broadcast to learn, and their logits to score, with ``CLASSES * BUCKETS`` class parameters.  The fit of the classes starts from a fit
to at most ``SEEDS`` documents; its rounds cover all training documents.

Defined results: null texts are empty (one token, the end); every input row gives one row, repeated rows included; rows
with null doc_id are scored, held_out false, and are not learnt from; without training tokens every word costs its
spelling by untrained predictors.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textvec import BYTE_CODES, NON_SPACE, U64, Words, distinct, mix, powers, slices

PAIR = -1  # the word so far and the word before it
CONTEXTS = (0, 1, 2, 3, 5, PAIR)
SLOTS = 1 << 19
BLOCK_TOKENS = 1 << 21
CLASSES = 8
BUCKETS = 128
SEEDS = 400
ROUNDS = 6
STEP = 0.02
BATCH_BITS = 1 << 14
REFINE = 24
SPAN = 1 << 10  # slots packed into one row when counters are added up
FAN = 32  # tasks whose counters are added up in the first step
WORDS = 1 << 9  # words learnt from at once
RARE = 8  # a gate of fewer than one in so many bits of a batch is handled apart
SPELT = 1 << 16  # words whose bytes are in memory at once, while counting and learning
COUNTED = 1 << 15  # the same, while scoring
MIXED = 1 << 17  # tokens of whole texts whose experts are mixed at once
NEAR = 1 << 14  # numbers worked on at once, so that they stay in a core's cache
_PACKED = "context long, span long, tree long, data binary"


def _nodes() -> np.ndarray:
    """For every byte value and each of its bits, a number for the bits of the byte so far; those of half a byte are neighbours."""
    value, shift = np.arange(256)[:, None], np.arange(3, -1, -1)
    half = [(1 << (3 - shift)) | (x >> (shift + 1)) for x in (value >> 4, value & 15)]
    return np.concatenate([half[0], ((1 + (value >> 4)) << 4) | half[1]], axis=1).astype(np.int64)


_NODES = _nodes()
_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int8)
_ONES = _BITS.astype(np.float32)
_ZEROS = 1 - _ONES
_OUT_NODES = (_NODES << 1) | _BITS  # of a slot and a bit
INNER = tuple(i for i, order in enumerate(CONTEXTS) if order != PAIR)
OUTER = CONTEXTS.index(PAIR)
# What a window of 8 bytes shows of a word that began so many bytes ago; the space before a word tells short windows apart.
_REACH = np.array([(1 << (8 * (i + 1))) - 1 for i in range(max(CONTEXTS) + 1)], np.uint64)


class _Spelt:
    """The bytes of words, each word ended by a space; what equal words share is worked out once.

    ``before`` are the hashes of the words before, 0 where there is none.  ``byte`` and ``first`` are of all words, ``own`` is
    of the distinct ones, and ``source`` says which of their bytes a byte is.
    """

    def __init__(self, words: pa.Array, before: np.ndarray | None = None):
        side, coded = pa.scalar(" ", pa.large_string()), words.cast(pa.large_string()).dictionary_encode()
        joined = pc.binary_join_element_wise(side, coded.dictionary, side, pa.scalar("", pa.large_string()))
        off = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        self.buf = np.frombuffer(joined.buffers()[2], np.uint8)[off[0] : off[-1]]
        off = off - off[0]
        inside = np.ones(len(self.buf), bool)
        inside[off[:-1]] = False  # the leading space is context only
        self.at = np.flatnonzero(inside)
        size = np.diff(off) - 1
        self.begin = np.repeat(off[:-1], size)
        self.own = self.buf[self.at]
        power, self.inverse = powers(len(self.buf))
        self.total = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(BYTE_CODES[self.buf] * power[: len(self.buf)], out=self.total[1:])
        word = coded.indices.to_numpy()
        self.size = size[word]
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.source = np.repeat((np.cumsum(size) - size)[word] - self.first[:-1], self.size)
        self.source += np.arange(len(self.source))
        self.byte = self.own[self.source]
        self.before = None if before is None else mix(before)

    def seen(self, order: int, which=slice(None)) -> np.ndarray:
        """What the context of each byte of the distinct words (of those at ``which``) is hashed from, but for the word before."""
        at, begin = self.at[which], self.begin[which]
        low = begin if order == PAIR else np.maximum(at - order, begin)
        return (self.total[at] - self.total[low]) * self.inverse[low] + (at - low).astype(np.uint64) * U64(64) + U64(order + 1)

    def base(self, order: int) -> np.ndarray:
        """Slot of the context of each byte; its bits' slots are that one, combined with their nodes."""
        seen = self.seen(order)
        if order != PAIR or self.before is None:
            return _slot(seen)[self.source]
        found = np.empty(len(self.source), np.int64)
        before = np.repeat(self.before, self.size)
        for a in range(0, len(found), NEAR):
            part = slice(a, a + NEAR)
            found[part] = _slot(seen[self.source[part]] + before[part])
        return found

    def states(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes after the same bytes of their words share their slots in all contexts but the word before: one byte of each
        such state, and the state of every byte; both of the distinct words."""
        window = np.ndarray(len(self.buf), ">u8", np.concatenate([np.zeros(7, np.uint8), self.buf]), strides=(1,))
        return distinct(window[self.at].astype(np.uint64) & _REACH[np.minimum(self.at - self.begin, len(_REACH) - 1)])


def _slot(seen: np.ndarray) -> np.ndarray:
    return (mix(seen) & U64(SLOTS - 1)).view(np.int64)


def _bits(words: pa.Array, before: np.ndarray | None = None, contexts: tuple[int, ...] = CONTEXTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every bit of every word and its ending space: slots by context, the bit; and the first bit of each word.

    ``before`` are the hashes of the words before, 0 where there is none.
    """
    spelt = _Spelt(words, before)
    nodes = _NODES[spelt.byte]
    slots = np.stack([spelt.base(order)[:, None] ^ nodes for order in contexts])
    return slots.reshape(len(contexts), -1), _BITS[spelt.byte].ravel(), spelt.first * 8


def _befores(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the word before each word; 0 for the first of a text (``first``: where each text starts)."""
    before = np.zeros(len(hashed), np.uint64)
    before[1:] = hashed[:-1]
    before[first[first < len(hashed)]] = 0
    return before


def _squash(z: np.ndarray, out: np.ndarray) -> np.ndarray:
    p = np.exp(np.negative(z, out=out), out=out)
    p += 1
    return np.reciprocal(p, out=p)


@dataclass
class Speller:
    """Counters of zeros and ones by context and slot, mixer weights by gate, and the refinement map."""

    zeros: np.ndarray
    ones: np.ndarray
    weights: np.ndarray
    refine: np.ndarray

    def parts(self) -> tuple[np.ndarray, ...]:
        """The arrays, for a broadcast that needs no class of this package on the executors."""
        return self.zeros, self.ones, self.weights, self.refine

    @classmethod
    def empty(cls) -> Speller:
        n = len(CONTEXTS)
        counters = np.zeros((n, SLOTS), np.float32)
        centre = np.linspace(-8, 8, REFINE)
        return cls(counters, counters.copy(), np.full((n + 1, n), 1.0 / n, np.float64), np.tile(1 / (1 + np.exp(-centre)), (n + 1, 1)))

    def logits(self, out: bool = False) -> np.ndarray:
        """Logit of every context and slot, 0 where the context is unknown (and nowhere else); with ``out`` by slot and bit,
        that bit left out of its own count."""
        zero, one = self.zeros, self.ones
        if out:
            zero = np.stack([np.maximum(zero - 1, 0), zero], axis=2).reshape(len(zero), -1)
            one = np.stack([one, np.maximum(one - 1, 0)], axis=2).reshape(len(one), -1)
        found = np.log((one + np.float32(0.2)) / (zero + np.float32(0.2)))
        found[found == 0] = 1e-9
        found[zero + one == 0] = 0
        return found

    def learn(self, slots: np.ndarray, bit: np.ndarray) -> None:
        """One online pass: after each small batch the weights take a gradient step and the map moves to what it saw."""
        table, desk = self.logits(out=True), _Desk()
        for a in range(0, len(bit), BATCH_BITS):
            y = bit[a : a + BATCH_BITS]
            logits, gate = desk.logits[:, : len(y)], desk.gate[: len(y)]
            for i, at in enumerate(slots[:, a : a + BATCH_BITS]):
                np.take(table[i], (at << 1) | y, out=logits[i], mode="clip")
            gate[:] = (logits != 0).sum(axis=0)
            desk.y[: len(y)] = y
            self._step(desk, len(y))

    def learn_words(self, words: pa.Array, before: np.ndarray, table: np.ndarray, desk: _Desk) -> int:
        """``learn`` from the bits of the words, ``WORDS`` words at a time, with ``table = logits(out=True)``; how many bits."""
        spelt = _Spelt(words, before)
        inner, known, state = self.inner(spelt, table, _OUT_NODES, 1)
        base = spelt.base(PAIR) << 1
        for a in range(0, len(words), WORDS):
            high = spelt.first[min(a + WORDS, len(words))]
            for low in range(spelt.first[a], high, BATCH_BITS // 8):
                part = slice(low, min(low + BATCH_BITS // 8, high))
                n = (part.stop - low) * 8
                for row, values in zip(INNER, inner):
                    np.take(values, state[part], axis=0, out=desk.bytes(desk.logits[row], n), mode="clip")
                desk.outer(base[part], spelt.byte[part], _OUT_NODES, table[OUTER])
                np.take(known, state[part], axis=0, out=desk.bytes(desk.gate, n), mode="clip")
                desk.gate[:n] += desk.known[:n]
                np.take(_ONES, spelt.byte[part], axis=0, out=desk.bytes(desk.y, n), mode="clip")
                self._step(desk, n)
        return len(spelt.byte) * 8

    @staticmethod
    def inner(spelt: _Spelt, table: np.ndarray, nodes: np.ndarray, shift: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Logits of each context inside the word by state and bit, how many of them are known, and the state of every byte."""
        one, state = spelt.states()
        own = nodes[spelt.own[one]]
        logits, known = [np.empty(own.shape, np.float32) for _ in INNER], np.zeros(own.shape, np.uint8)
        for i, found in zip(INNER, logits):
            base = _slot(spelt.seen(CONTEXTS[i], one)) << shift
            for a in range(0, len(one), BATCH_BITS // 8):
                part = slice(a, a + BATCH_BITS // 8)
                np.take(table[i], base[part, None] ^ own[part], out=found[part], mode="clip")
            known += found != 0
        return logits, known, state[spelt.source]

    def _step(self, desk: _Desk, n: int) -> None:
        """A gradient step from the ``n`` bits on the desk: their logits, gates and values."""
        logits, gate, y = desk.logits[:, :n], desk.gate[:n], desk.y[:n]
        z, error, part = desk.z[:n], desk.error[:n], desk.part[:n]
        weights = self.weights.astype(np.float32)
        frequent, rare, left = [], [], n
        for g in range(len(weights) - 1, -1, -1):  # most bits know most of their contexts
            own = np.equal(gate, g, out=desk.own[g, :n])
            often = np.count_nonzero(own)
            if often * RARE > n:
                frequent.append((g, own, often))
            elif often:
                at = np.flatnonzero(own)
                rare.append((g, at, np.take(logits, at, axis=1), often))
            left -= often
            if not left:
                break
        if len(frequent) == 1:  # the rare ones are set right below
            np.dot(weights[frequent[0][0]], logits, out=z)
        else:
            z[:] = 0
            for g, own, _ in frequent:
                np.dot(weights[g], logits, out=part)
                part *= own
                z += part
        for g, at, few, _ in rare:
            z[at] = np.dot(weights[g], few)
        np.clip(z, -8, 8, out=z)
        _squash(z, out=error)
        np.subtract(y, error, out=error)
        z += np.float32(8)
        z *= np.float32((REFINE - 1) / 16)
        z += np.float32(0.5)
        near = np.floor(z, out=z)
        if len(frequent) == 1:
            near += np.float32(frequent[0][0] * REFINE)
            for g, at, _, _ in rare:
                near[at] += np.float32((g - frequent[0][0]) * REFINE)
        else:
            near += np.multiply(gate, np.float32(REFINE), out=part)
        near *= 2
        near += y
        np.copyto(desk.at[:n], near, casting="unsafe")
        for g, at, few, often in rare:
            self.weights[g] += STEP * (few @ error[at]) / np.sqrt(often)
        if len(frequent) == 1:
            for _, at, _, _ in rare:
                error[at] = 0
        for g, own, often in frequent:
            self.weights[g] += STEP * (logits @ (error if len(frequent) == 1 else np.multiply(own, error, out=part))) / np.sqrt(often)
        seen = np.bincount(desk.at[:n], minlength=2 * self.refine.size).reshape(*self.refine.shape, 2)
        often = seen.sum(axis=2)
        self.refine += often / (often + 200.0) * (seen[:, :, 1] / np.maximum(often, 1) - self.refine)

    def cost(self, words: pa.Array, before: np.ndarray | None = None, table: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each word's bytes and ending space, after the words ``before``.

        ``table`` is ``logits()``, where it is known already."""
        table = self.logits() if table is None else table
        desk, out = _Desk(), []
        outer = self.weights[:, OUTER].astype(np.float32)
        flat = self.refine.ravel().astype(np.float32)
        lines = flat, np.append(np.diff(flat), np.float32(0))
        for a in range(0, len(words), COUNTED):
            spelt = _Spelt(words.slice(a, COUNTED), None if before is None else before[a : a + COUNTED])
            inner, known, state = self.inner(spelt, table, _NODES, 0)
            # The mixed value by state, without a word before and with a known one, but for that one's own part.
            alone, full = self._mixed(inner, known, 0), self._mixed(inner, known, 1)
            base, logs = spelt.base(PAIR), np.empty(2 * len(spelt.byte), np.float32)
            for low in range(0, len(spelt.byte), BATCH_BITS // 8):
                part = slice(low, min(low + BATCH_BITS // 8, len(spelt.byte)))
                n, here = (part.stop - low) * 8, state[part]
                for values, to in ((full, desk.z), (known, desk.gate)):
                    np.take(values, here, axis=0, out=desk.bytes(to, n), mode="clip")
                logit = desk.outer(base[part], spelt.byte[part], _NODES, table[OUTER])
                z, gate = desk.z[:n], desk.gate[:n]
                gate += desk.known[:n]
                z += np.multiply(logit, outer[-1], out=desk.part[:n])
                rest = np.flatnonzero(np.not_equal(gate, len(CONTEXTS), out=desk.own[0, :n]))
                if len(rest):  # some context is unknown
                    own = here[rest >> 3], rest & 7
                    z[rest] = np.where(desk.known[rest], full[own] + logit[rest] * outer[gate[rest]], alone[own])
                np.clip(z, -8, 8, out=z)
                p = self._refined(desk, n, rest, *lines)
                p -= np.take(_ZEROS, spelt.byte[part], axis=0, out=desk.bytes(desk.y, n), mode="clip").ravel()
                np.abs(p, out=p)  # of the bit that came
                p = p[0::2] * p[1::2]
                np.log(p[0::2] * p[1::2], out=logs[2 * low : 2 * part.stop])
            out.append(np.add.reduceat(logs, 2 * spelt.first[:-1], dtype=np.float64))
        return np.concatenate(out) / np.log(10) if out else np.zeros(0)

    def _mixed(self, inner: list[np.ndarray], known: np.ndarray, more: int) -> np.ndarray:
        """Mixed value of the contexts inside the word, by state and bit, where ``more`` other contexts are known."""
        weights, usual = self.weights.astype(np.float32), len(INNER)
        found = weights[usual + more, INNER[0]] * inner[0]
        for i, logits in zip(INNER[1:], inner[1:]):
            found += weights[usual + more, i] * logits
        rest = np.nonzero(known != usual)
        if len(rest[0]):
            found[rest] = sum(np.take(weights[:, i], known[rest] + more) * logits[rest] for i, logits in zip(INNER, inner))
        return found

    def _refined(self, desk: _Desk, n: int, rest: np.ndarray, flat: np.ndarray, rise: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean of the mixed value's and the map's, interpolated between its two buckets.

        ``rest`` are the bits that do not know all contexts; the map comes as its values and their differences."""
        gate, z, part, low, p = (x[:n] for x in (desk.gate, desk.z, desk.part, desk.error, desk.p))
        np.add(z, np.float32(8), out=part)
        part *= np.float32((REFINE - 1) / 16)
        np.minimum(np.floor(part, out=low), np.float32(REFINE - 2), out=low)
        part -= low
        low += np.float32(len(CONTEXTS) * REFINE)
        if len(rest):
            low[rest] -= (len(CONTEXTS) - gate[rest].astype(np.float32)) * np.float32(REFINE)
        np.copyto(desk.at[:n], low, casting="unsafe")
        np.take(rise, desk.at[:n], out=p, mode="clip")
        p *= part
        p += np.take(flat, desk.at[:n], out=part, mode="clip")
        p += _squash(z, out=part)
        p *= np.float32(0.5)
        return p  # neither near 0 nor near 1, as the mixed value is not


class _Desk:
    """Arrays for a batch of bits, used again for the next one: new ones would cost more than what is done in them."""

    def __init__(self):
        # Rows a little longer than the batch: at a power of two from each other they would share lines of the cache.
        self.logits = np.empty((len(CONTEXTS), BATCH_BITS + 80), np.float32)[:, :BATCH_BITS]
        self.y, self.z, self.error, self.part, self.p = np.empty((5, BATCH_BITS), np.float32)
        self.gate = np.empty(BATCH_BITS, np.uint8)
        self.own = np.empty((len(CONTEXTS) + 1, BATCH_BITS), bool)
        self.known = np.empty(BATCH_BITS, bool)
        self.at = np.empty(BATCH_BITS, np.int64)

    @staticmethod
    def bytes(row: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` bits of a row, by byte."""
        return row[:n].reshape(-1, 8)

    def outer(self, base: np.ndarray, byte: np.ndarray, nodes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Logits of the context of the word before; ``known`` tells where there are any."""
        n = 8 * len(byte)
        at = np.take(nodes, byte, axis=0, out=self.bytes(self.at, n), mode="clip")
        at ^= base[:, None]
        logits = np.take(table, self.at[:n], out=self.logits[OUTER, :n], mode="clip")
        np.not_equal(logits, 0, out=self.known[:n])
        return logits


def _histograms(words: Words, hashed: np.ndarray) -> np.ndarray:
    """Words of each text by hash bucket."""
    flat = words.doc * BUCKETS + (hashed >> U64(64 - 7)).astype(np.int64)
    return np.bincount(flat, minlength=words.n * BUCKETS).reshape(words.n, BUCKETS)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 20):
            words = Words(batch["text"].slice(low, high - low), NON_SPACE, lower=True)
            counts = _histograms(words, words.hashes()).astype(np.uint32)
            arrays = [batch["doc_id"].slice(low, high - low), pa.array([c.tobytes() for c in counts], pa.binary()), pa.array(words.count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "counts", "words"])


def _classify(x: np.ndarray, log_theta: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    """Posterior of each class for histograms ``x``."""
    z = x @ log_theta.T + log_prior
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _matrix(counts: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(counts.to_pylist()), np.uint32).reshape(len(counts), BUCKETS).astype(np.float64)


def _responsibilities(log_theta: np.ndarray, log_prior: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CLASSES, BUCKETS + 1))
        for batch in batches:
            x = _matrix(batch["counts"])
            share = _classify(x, log_theta, log_prior)
            sums[:, :BUCKETS] += share.T @ x
            sums[:, BUCKETS] += share.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["at", "value"])

    return run


def _maximise(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    theta = sums[:, :BUCKETS] + 0.1
    prior = sums[:, BUCKETS] + 1
    return theta / theta.sum(axis=1, keepdims=True), prior / prior.sum()


def _start(x: np.ndarray, tries: int = 12, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """The most likely of several fits to a few documents, each started from ``CLASSES`` of them."""
    best = -np.inf, np.full((CLASSES, BUCKETS), 1 / BUCKETS), np.full(CLASSES, 1 / CLASSES)
    rng = np.random.Generator(np.random.PCG64(5))
    if len(x) < CLASSES:
        return best[1:]
    for _ in range(tries):
        theta, prior = _maximise(np.concatenate([x[rng.choice(len(x), CLASSES, replace=False)] + 1, np.ones((CLASSES, 1))], axis=1))
        for _ in range(rounds):
            share = _classify(x, np.log(theta), np.log(prior))
            theta, prior = _maximise(np.concatenate([share.T @ x, share.sum(axis=0)[:, None]], axis=1))
        z = x @ np.log(theta).T + np.log(prior)
        likelihood = (z.max(axis=1) + np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1))).sum()
        if likelihood > best[0]:
            best = likelihood, theta, prior
    return best[1:]


def fit_classes(source: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``(log word shares by class, log class shares)`` of a mixture of multinomials over all learnt documents."""
    table = cut_lineage(source.where("learn").select("doc_id", "text").mapInArrow(_profiles, "doc_id long, counts binary, words long"), "profiles")
    seeds = table.where("words >= 50").orderBy(F.xxhash64("doc_id"), "doc_id", "counts").limit(SEEDS).toPandas()
    theta, prior = _start(np.array([np.frombuffer(c, np.uint32) for c in seeds["counts"]], np.float64).reshape(-1, BUCKETS))
    for _ in range(ROUNDS):
        step = table.mapInArrow(_responsibilities(np.log(theta), np.log(prior)), "at long, value double")
        sums = np.zeros(CLASSES * (BUCKETS + 1))
        for row in step.groupBy("at").agg(F.sum("value").alias("value")).collect():  # CLASSES * (BUCKETS + 1) rows
            sums[row["at"]] = row["value"]
        sums = np.round(sums.reshape(CLASSES, -1), 6)  # sums in another order must not change a class
        theta, prior = _maximise(sums)
    return np.log(theta), np.log(prior)


class _Block:
    """Documents of one class waiting to be written together."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.learn: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.words: list[tuple[np.ndarray, pa.Array]] = []
        self.size = 0

    def batches(self, block: int, label: int) -> Iterator[pa.RecordBatch]:
        hashed, counts = np.concatenate(self.hashes), np.concatenate(self.counts)
        key, which = np.unique(hashed, return_inverse=True)
        # The block's words by falling frequency: small indexes for frequent words, which pack well.
        order = np.argsort(-np.bincount(which, minlength=len(key)), kind="stable")
        place = np.empty(len(key), np.int32)
        place[order] = np.arange(len(key), dtype=np.int32)
        learnt = np.bincount(which[np.repeat(np.concatenate(self.learn), counts)], minlength=len(key))[order]
        which = place[which]
        key = key[order]
        first = np.concatenate([[0], np.cumsum(counts)])
        docs = pa.Table.from_batches(self.rows).combine_chunks()
        n, m = len(docs), len(key)
        codec = zstandard.ZstdCompressor(level=1)
        tokens = pa.array([_planes(codec, which[a:b]) for a, b in zip(first[:-1], first[1:])], pa.binary())
        arrays = [*(docs[c].combine_chunks() for c in ("doc_id", "held_out", "n_bytes")), tokens, *(pa.nulls(n, f.type) for f in _BLOCK_SCHEMA[6:])]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.full(n, label)), *arrays], schema=pa.schema(_BLOCK_SCHEMA))
        if m:
            own, texts = np.concatenate([w[0] for w in self.words]), pa.concat_arrays([w[1] for w in self.words])
            _, at = np.unique(own, return_index=True)
            arrays = [pa.array(np.arange(m)), pa.array(key.view(np.int64)), texts.take(pa.array(at[order])).cast(pa.string()), pa.array(learnt)]
            arrays = [*(pa.nulls(m, f.type) for f in _BLOCK_SCHEMA[2:6]), *arrays]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), pa.array(np.full(m, label)), *arrays], schema=pa.schema(_BLOCK_SCHEMA))


_BLOCK_SCHEMA = [
    pa.field("block", pa.int64()), pa.field("class", pa.int64()), pa.field("doc_id", pa.int64()), pa.field("held_out", pa.bool_()),
    pa.field("n_bytes", pa.int64()), pa.field("tokens", pa.binary()), pa.field("at", pa.int64()), pa.field("key", pa.int64()),
    pa.field("word", pa.string()), pa.field("learnt", pa.int64()),
]
_BLOCKS = "block long, class long, doc_id long, held_out boolean, n_bytes long, tokens binary, at long, key long, word string, learnt long"


def _blocks(log_theta: np.ndarray, log_prior: np.ndarray):
    """Blocks of documents of one class: a row per document with its tokens as indexes into the block's words, and a row
    per word of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        waiting = [_Block() for _ in range(CLASSES)]
        for batch in batches:
            for low, high in slices(batch["text"], 1 << 20):
                part = batch.slice(low, high - low)
                words = Words(part["text"], NON_SPACE, lower=True)
                hashed = words.hashes()
                labels = _classify(_histograms(words, hashed).astype(np.float64), log_theta, log_prior).argmax(axis=1)
                size = pc.cast(pc.fill_null(pc.binary_length(part["text"]), 0), pa.int64())
                rows = pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], size], names=["doc_id", "held_out", "n_bytes"])
                learn = part["learn"].to_numpy(zero_copy_only=False)
                for label in np.unique(labels):
                    own, block = labels == label, waiting[label]
                    at = np.flatnonzero(own[words.doc])
                    block.rows.append(rows.filter(pa.array(own)))
                    block.counts.append(words.count[own])
                    block.learn.append(learn[own])
                    block.hashes.append(hashed[at])
                    keys, first = np.unique(hashed[at], return_index=True)
                    block.words.append((keys, words.strings(at[first])))
                    block.size += len(at)
                    if block.size >= BLOCK_TOKENS:
                        yield from block.batches(number, int(label))
                        number, waiting[label] = number + 1, _Block()
        for label, block in enumerate(waiting):
            if block.rows:
                yield from block.batches(number, label)
                number += 1

    return run


def _pack(table: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """``(context, span, counters)`` of the spans of slots that hold anything; the table has zeros and ones by context and slot."""
    codec = zstandard.ZstdCompressor(level=1)
    for i, counters in enumerate(table):
        spans = counters.reshape(-1, SPAN, 2)
        for j in np.flatnonzero(spans.any(axis=(1, 2))):
            yield i, int(j), _planes(codec, spans[j].T)


def _planes(codec: zstandard.ZstdCompressor, values: np.ndarray) -> bytes:
    """Numbers byte by byte of their places, compressed: the upper bytes of small numbers take no room."""
    return codec.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unplanes(codec: zstandard.ZstdDecompressor, data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(codec.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _stream(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """The words of the texts, slice by slice, with their hashes and those of the words before them."""
    for batch in batches:
        for low, high in slices(batch["text"], size):
            words = Words(batch["text"].slice(low, high - low), NON_SPACE, lower=True)
            hashed = words.hashes()
            yield words, hashed, _befores(hashed, words.first[:-1])


def _pairs(hashed: np.ndarray, before: np.ndarray) -> np.ndarray:
    """64-bit name of each word after the word before it."""
    return mix(hashed + mix(before + U64(1)))


class _Tally:
    """Counters of zeros and ones by context and slot.

    Half bytes are counted by the slot of their context, which their four bits' slots differ from in the last four bits only;
    ``table`` has them by bit, after ``settle``.
    """

    def __init__(self):
        self.halves = [np.zeros(SLOTS * 16, np.int32) for _ in CONTEXTS]
        self.table = np.zeros((len(CONTEXTS), 2 * SLOTS), np.int64)
        self.waiting = 0

    def add(self, context: int, base: np.ndarray, byte: np.ndarray, often: np.ndarray) -> None:
        high = (byte >> 4).astype(np.int64)
        np.add.at(self.halves[context], (base << 4) | high, often)
        np.add.at(self.halves[context], ((base ^ ((1 + high) << 4)) << 4) | (byte & 15), often)

    def count(self, spelt: _Spelt) -> None:
        if self.waiting + len(spelt.byte) >= 1 << 30:  # two halves a byte
            self.settle()
        self.waiting += len(spelt.byte)
        one, state = spelt.states()
        often = np.bincount(state[spelt.source], minlength=len(one)).astype(np.int32)
        for i in INNER:
            self.add(i, _slot(spelt.seen(CONTEXTS[i], one)), spelt.own[one], often)
        self.add(OUTER, spelt.base(PAIR), spelt.byte, np.ones(len(spelt.byte), np.int32))

    def settle(self) -> None:
        slot = np.arange(16)
        for i, table in enumerate(self.table):
            rows = self.halves[i].reshape(-1, 16, 16)
            used = np.flatnonzero(rows.any(axis=(1, 2)))
            for a in range(0, len(used), NEAR // 256):
                at = used[a : a + NEAR // 256]
                seen = rows[at].astype(np.int64)  # by the first bits of the half byte: four, then three, two, one
                bits = np.zeros((len(at), 16, 2), np.int64)
                for depth in range(3, -1, -1):
                    for start in range(1 << depth):
                        bits += seen[:, slot ^ ((1 << depth) | start), 2 * start : 2 * start + 2]
                    seen = seen[:, :, 0::2] + seen[:, :, 1::2]
                table.reshape(-1, 16, 2)[at] += bits
            del rows
            self.halves[i] = np.zeros(SLOTS * 16, np.int32)  # a new one: zeros that are written take memory, even where none was used
        self.waiting = 0


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the training texts, counted by context and slot: a state that some words repeat is counted that often at once."""
    tally = _Tally()
    for words, hashed, before in _stream(batches, 1 << 18):  # short slices: the counters take much memory already
        for a in range(0, len(before), SPELT):
            part = np.arange(a, min(a + SPELT, len(before)))
            tally.count(_Spelt(words.strings(part), before[part]))
    tally.settle()
    table = tally.table
    del tally
    rows = list(_pack(table))
    if rows:
        context, span, data = zip(*rows)
        tree = pa.array(np.full(len(rows), TaskContext.get().partitionId() // FAN))
        yield pa.RecordBatch.from_arrays([pa.array(context, pa.int64()), pa.array(span, pa.int64()), tree, pa.array(data, pa.binary())], names=["context", "span", "tree", "data"])


def _add(rows: pa.Table) -> pa.Table:
    codec, total = zstandard.ZstdDecompressor(), np.zeros(2 * SPAN, np.int64)
    for x in rows["data"].to_pylist():
        total += _unplanes(codec, x, np.int64)
    data = _planes(zstandard.ZstdCompressor(level=1), total)
    return pa.table({"context": rows["context"][:1], "span": rows["span"][:1], "tree": pa.array([0], pa.int64()), "data": pa.array([data], pa.binary())})


def _learner(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The weights and map after an online pass over this partition's texts, with the number of bits."""
        zeros, ones, weights, refine = model.value
        speller, n = Speller(zeros, ones, weights.copy(), refine.copy()), 0
        table, desk = speller.logits(out=True), _Desk()
        for words, _, before in _stream(batches):
            for a in range(0, len(before), SPELT):
                part = np.arange(a, min(a + SPELT, len(before)))
                n += speller.learn_words(words.strings(part), before[part], table, desk)
        if n:
            flat = np.concatenate([speller.weights.ravel(), speller.refine.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), n))], names=["at", "value", "bits"])

    return run


def train_speller(docs: DataFrame) -> Speller:
    """Speller from the training texts ``(text)``: counters of every bit of every token, then one online pass over the same
    tokens for weights and map.

    Every partition makes its own pass from the same start; the results are averaged by the number of bits.
    """
    speller = Speller.empty()
    packed = docs.select("text").mapInArrow(_counters, _PACKED)
    # Added up in two steps, so that no group holds the counters of all tasks.
    part = packed.groupBy("context", "span", "tree").applyInArrow(_add, _PACKED)
    codec = zstandard.ZstdDecompressor()
    for row in part.groupBy("context", "span").applyInArrow(_add, _PACKED).toLocalIterator():
        pair = _unplanes(codec, row["data"], np.int64).reshape(2, SPAN)  # at most 2 * len(CONTEXTS) * SLOTS counters in all
        at = slice(row["span"] * SPAN, (row["span"] + 1) * SPAN)
        speller.zeros[row["context"], at], speller.ones[row["context"], at] = pair
    start = docs.sparkSession.sparkContext.broadcast(speller.parts())
    learnt = docs.select("text").mapInArrow(_learner(start), "at long, value double, bits long")
    table = learnt.groupBy("at").agg((F.sum(F.col("value") * F.col("bits")) / F.sum("bits")).alias("value")).orderBy("at").toPandas()
    if len(table):
        flat, n = table["value"].to_numpy(np.float64), speller.weights.size
        speller.weights = flat[:n].reshape(speller.weights.shape)
        speller.refine = flat[n:].reshape(speller.refine.shape)
    return speller


@dataclass
class Totals:
    """Training tokens, distinct tokens, documents, words seen once; and by class tokens and words, and words seen once or twice."""

    tokens: int
    distinct: int
    ends: int
    once: int
    by_class: np.ndarray


def _scorer(t: Totals, model):
    """Scores of a block's documents from its words' counts and the bit mixer (its logits, weights and map)."""
    learnt, types, once, twice = (np.maximum(t.by_class[:, i], 0.0) for i in range(4))
    discount = (once + 1) / (once + 2 * twice + 2)
    backoff = np.where(learnt > 0, discount * types / np.maximum(learnt, 1), 1.0)
    # Among words new to their class, the share that is new to the corpus as well.
    escape = min(max((t.once + 1) / (once.sum() + 2), 1e-3), 1.0) if t.tokens else 1.0

    end = max((t.ends + 0.5) / (t.tokens + 0.5 * (t.distinct + 1)), 1e-9)
    end_base = np.log10((t.ends + 0.5) / (t.tokens + 0.5 * (t.distinct + 1)))

    def texts_scores(flat: np.ndarray, mixed: np.ndarray, size: np.ndarray, words: tuple[np.ndarray, ...], label: int) -> tuple[np.ndarray, ...]:
        """Score, base score and known tokens of some texts, without their ends: from the words and the bit mixer's
        probability of every token, and ``words``: probability by vocabulary, base and whether it is known, by word."""
        counted, base, known = words
        first = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(flat)) - np.repeat(first[:-1], size)
        # How often the document has had the word before: rank among equal (document, word) pairs in order.
        pair = owner * max(len(known), 1) + flat
        rank_order = np.argsort(pair, kind="stable")
        new = np.ones(len(flat), bool)
        new[1:] = pair[rank_order][1:] != pair[rank_order][:-1]
        run_start = np.maximum.accumulate(np.where(new, np.arange(len(flat)), 0)) if len(flat) else np.zeros(0, np.int64)
        before = np.empty(len(flat), np.int64)
        before[rank_order] = np.arange(len(flat)) - run_start
        seen = before / np.maximum(at, 1)
        prior = counted[flat] + backoff[label] * escape * mixed
        # Blocks of a document double in length; the gate is refined after each.
        level = np.floor(np.log2(at / 16 + 1)).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
        gate = np.full((2, len(size)), -2.0)  # of the text itself and the bit mixer, against the vocabulary
        logs = np.zeros(len(flat))
        for step in range(int(level.max()) + 1 if len(flat) else 0):
            own = np.flatnonzero(level == step)
            doc = owner[own]
            odds = np.exp(gate)[:, doc]
            odds[0] *= at[own] > 0
            share = odds / (1 + odds.sum(axis=0))
            experts = np.stack([seen[own], mixed[own]])
            p = (share * experts).sum(axis=0) + (1 - share.sum(axis=0)) * prior[own]
            logs[own] = np.log10(np.maximum(p, 1e-300))
            slope = share * (experts - p) / np.maximum(p, 1e-300)
            n = np.bincount(doc, minlength=len(size))
            gate += 8.0 * np.stack([np.bincount(doc, weights=x, minlength=len(size)) for x in slope]) / np.maximum(n, 1)
            gate = np.clip(gate, -6, 3)
        odds = np.exp(gate)
        last = np.log10(np.where(size > 0, 1 / (1 + odds.sum(axis=0)) * end, end))

        def per_doc(values: np.ndarray) -> np.ndarray:
            total_ = np.concatenate([[0], np.cumsum(values)])
            return total_[first[1:]] - total_[first[:-1]]

        return per_doc(logs) + last, per_doc(base[flat]), per_doc(known[flat].astype(np.int64))

    def run(rows: pa.Table, counted: pa.Table) -> pa.Table:
        named = pc.is_valid(rows["word"])
        docs, words = rows.select(["class", "doc_id", "held_out", "n_bytes", "tokens"]).filter(pc.invert(named)), rows.select(["place", "word"]).filter(named)
        del rows, named
        label = int(docs["class"][0].as_py()) if len(docs) else 0
        order = np.argsort(counted["at"].to_numpy())
        c, mine = (counted[x].to_numpy()[order].astype(np.float64) for x in ("c", "mine"))
        texts = words["word"].combine_chunks().take(pa.array(np.argsort(words["place"].to_numpy())))
        del words, order
        key = np.concatenate([np.zeros(0, np.uint64), *(Words(texts.slice(a, COUNTED), NON_SPACE, lower=False).hashes() for a in range(0, len(texts), COUNTED))])
        base = np.log10((c + 0.5) / (t.tokens + 0.5 * (t.distinct + 1)))
        counted = np.maximum(mine - discount[label], 0) / max(learnt[label], 1) + backoff[label] * (1 - escape) * c / max(t.tokens, 1)
        codec = zstandard.ZstdDecompressor()
        tokens = [_unplanes(codec, x.as_py(), np.int32) for chunk in docs["tokens"].chunks for x in chunk]
        size = np.array([len(x) for x in tokens], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *tokens])
        del tokens
        first = np.concatenate([[0], np.cumsum(size)])
        # The bit mixer's probability of every token: its contexts are the word and the word before, so equal pairs share one.
        before = np.full(len(flat), len(key), np.int32)  # that many: none
        before[1:] = flat[:-1]
        before[first[:-1][size > 0]] = len(key)
        one, which = distinct(before.astype(np.uint64) * U64(max(len(key), 1)) + flat.astype(np.uint64))
        # By word, so that the states of a word are met in one go.
        order = np.argsort(flat[one], kind="stable")
        place = np.empty(len(one), np.int32)
        place[order] = np.arange(len(one), dtype=np.int32)
        which, one = place[which], one[order]
        word, before = flat[one], np.append(key, U64(0))[before[one]]
        del key, one, order, place
        table, weights, refine = model.value
        speller = Speller(np.zeros(0), np.zeros(0), weights, refine)
        mixed = np.empty(len(word))
        for a in range(0, len(word), COUNTED):
            at_once = slice(a, a + COUNTED)
            mixed[at_once] = 10.0 ** speller.cost(texts.take(pa.array(word[at_once])), before[at_once], table)
        del texts, word, before
        found, low = [(np.zeros(0), np.zeros(0), np.zeros(0, np.int64))], 0
        while low < len(size):  # whole texts, some at a time
            high = max(low + 1, int(np.searchsorted(first, first[low] + MIXED, side="right")) - 1)
            part = slice(first[low], first[high])
            found.append(texts_scores(flat[part].astype(np.int64), mixed[which[part]], size[low:high], (counted, base, c > 0), label))
            low = high
        score, base, known = (np.concatenate(x) for x in zip(*found))
        score -= np.log10(CLASSES)
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "held_out": docs["held_out"],
                "n_tokens": pa.array(size + 1),
                "n_known": pa.array(known + int(t.ends > 0)),
                "train_tokens": pa.array(np.full(len(size), t.tokens)),
                "base_score": pa.array(base + end_base),
                "score": pa.array(score),
                "bits_per_byte": pa.array(-score / np.log10(2) / np.maximum(docs["n_bytes"].to_numpy() + 1, 1)),
            }
        )

    return run


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(remainder == 1, F.lit(False)).alias("held_out"),
        F.coalesce(remainder != 1, F.lit(False)).alias("learn"),
    )
    blocks = cut_lineage(source.mapInArrow(_blocks(*fit_classes(source)), _BLOCKS), "blocks", "zstd")
    words = blocks.where("key is not null")
    by_class = [F.sum(F.when(F.col("class") == k, F.col("learnt")).otherwise(0)).alias(f"c{k}") for k in range(CLASSES)]
    # A word has one row per block, so rows are dealt by word before they are added up, without the classes' empty columns.
    grouped = words.select("key", "class", "learnt").repartition("key").groupBy("key")
    counts = cut_lineage(grouped.agg(F.sum("learnt").alias("c"), *by_class), "counts", "zstd")
    known = counts.where("c > 0")
    each = []
    for k in range(CLASSES):
        own = F.col(f"c{k}")
        each += [F.sum(own).alias(f"n{k}"), *(F.count(F.when(test, 1)).alias(f"{x}{k}") for x, test in (("v", own > 0), ("a", own == 1), ("b", own == 2)))]
    sums = known.agg(F.count("*").alias("v"), F.sum("c").alias("n"), F.count(F.when(F.col("c") == 1, 1)).alias("once"), *each).first()
    ends = source.where("learn").count()
    table = np.array([[float(sums[f"{x}{k}"] or 0) for x in "nvab"] for k in range(CLASSES)])
    totals = Totals(int(sums["n"] or 0) + ends, int(sums["v"]) + (ends > 0), ends, int(sums["once"]), table)
    speller = train_speller(source.where("learn"))
    model = docs.sparkSession.sparkContext.broadcast((speller.logits(), speller.weights, speller.refine))
    del speller
    mine = F.element_at(F.array(*(f"c{k}" for k in range(CLASSES))), (F.col("class") + 1).cast("int"))
    # Only the numbers of a block's words are dealt by word; the words themselves go with the block's documents.
    wanted = words.select("block", "class", "at", "key").join(counts, "key").select("block", "at", "c", mine.alias("mine"))
    return (
        blocks.select(F.col("block").alias("part"), "class", "doc_id", "held_out", "n_bytes", "tokens", F.col("at").alias("place"), "word").groupBy("part")
        .cogroup(wanted.groupBy("block"))
        .applyInArrow(
            _scorer(totals, model),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double",
        )
    )
