"""Vectorised word splitting and hashing of Arrow text batches.

Every function works on one Arrow batch at a time with NumPy; Spark does the partitioning.  Texts are handled as
UTF-8 bytes: both word patterns of the operators treat every byte above 0x7F as part of a word, so splitting bytes and
splitting code points give the same words.  Memory is about 40 bytes per byte of the slice at hand; ``slices`` keeps
slices near ``SLICE_BYTES`` unless one text alone is longer (whole texts are never cut).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 18

# Word bytes of the two patterns: [^\x20\x09-\x0D]+ and (after lower-casing) [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_TABLES = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    global _TABLES
    if len(_TABLES[0]) < n:
        _TABLES = tuple(
            np.cumprod(np.concatenate([[U64(1)], np.full((1 << max(n.bit_length(), 16)) - 1, base, np.uint64)]), dtype=np.uint64)
            for base in (_BASE, _INVERSE)
        )
    return _TABLES


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each range: prefix sums of position-weighted byte codes, shifted back and mixed."""
    power, inverse = powers(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_CODES[buf] * power[: len(buf)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    return mix(value + (end - start).astype(np.uint64))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of each distinct value, in rising order, and for every position the number of its value among them.

    Values that meet another one in their place of the table are sorted.
    """
    n = len(values)
    slot = ((values * _BASE) >> U64(63 - n.bit_length())).view(np.int64)
    table = np.empty(1 << (n.bit_length() + 1), np.int32 if n < 1 << 31 else np.int64)
    table[slot] = np.arange(n, dtype=table.dtype)
    one = np.take(table, slot)
    rest = np.flatnonzero(values[one] != values)
    if len(rest):
        _, first, back = np.unique(values[rest], return_index=True, return_inverse=True)
        one[rest] = rest[first][back]
    new = np.zeros(n, bool)
    new[one] = True
    return np.flatnonzero(new), (np.cumsum(new) - 1)[one]


class Words:
    """Words of a slice of texts: byte ranges, owner text, and first word of each text."""

    def __init__(self, texts: pa.Array, table: np.ndarray, lower: bool):
        texts = texts.cast(pa.large_string()).fill_null("")
        joined = pc.binary_join_element_wise(texts, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))  # every text ends in a space
        off = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        data = joined.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if len(joined) and data is not None else np.zeros(0, np.uint8)
        self.n = len(texts)
        self.text_at = off - off[0] if len(joined) else np.zeros(1, np.int64)
        self.buf = LOWER[raw] if lower else raw
        inside = table[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.text_at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.count)
        self.inside = inside

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        return range_hashes(self.buf, self.start, self.end)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words at the given positions as an Arrow string array."""
        size = (self.end - self.start)[which]
        off = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[which] - off[:-1], size) + np.arange(off[-1])
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(self.buf[at].tobytes()))

    def grams(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each position; positions too near their text's end are wrong (see ``whole``)."""
        n = len(words)
        power, inverse = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(words * power[1 : n + 1], out=total[1:])
        out = np.full(n, total[n])
        out[: max(n - k + 1, 0)] = total[k:]
        out -= total[:n]
        out *= inverse[:n]
        return mix(out)

    def whole(self, k: int) -> np.ndarray:
        """True where ``k`` words from the position stay inside the text."""
        last = np.repeat(self.first[1:], self.count)
        return np.arange(len(last)) + k <= last


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text each."""
    n = len(texts)
    if not n:
        return
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low, base = 0, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(total, base + size, side="right")))
        yield low, high
        low, base = high, int(total[high - 1])
