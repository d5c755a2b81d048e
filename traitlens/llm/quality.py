"""Quality rules (operator 3): base word rules, then zstandard compression bands by text length.

Words are ``[^\\x20\\x09-\\x0D]+``.  A text fails the base rules with fewer than 10 words, or when more than a fifth of its
words lie in 5-word windows that occur twice or more in it.  The method's verdict comes from compression: the ratio
(bytes / compressed bytes) of the whole text must lie in the band of its length class, and so must the ratios of its
fixed chunks of ``CHUNK`` bytes (at most a quarter of them may be outside).  Ratios above a band mean repetition,
ratios below it noise.

Defined results: null and word-less texts have no words and fail; every input row gives one row.  Whole texts are
compressed, however long.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import NON_SPACE, U64, Words, mix, slices

LEVEL = 3
CHUNK = 4096
MIN_WORDS = 10
REPEAT_WINDOW = 5

# (bytes up to and including, least ratio, greatest ratio).  Longer texts compress better, so every octave of length has
# its own band up to where the ratio levels off, at the compressor's window of 2 MB; the upper limits lie above what
# ordinary prose of that length reaches at this level, by 0.2 or more from 128 KB on (German, the highest: 2.61 at 256 KB,
# 2.76 at 512 KB, 2.78 at 1 MB, 2.81 at 3 MB).
BANDS = [
    (128, 0.0, 1.6),
    (256, 0.9, 1.9),
    (512, 1.1, 2.0),
    (1024, 1.3, 2.15),
    (2048, 1.5, 2.25),
    (4096, 1.6, 2.3),
    (8192, 1.7, 2.42),
    (16384, 1.8, 2.5),
    (32768, 1.9, 2.6),
    (65536, 1.9, 2.65),
    (131072, 1.9, 2.85),
    (262144, 1.9, 2.9),
    (524288, 1.9, 3.0),
    (1 << 20, 1.9, 3.05),
    (1 << 62, 1.9, 3.1),
]
CHUNK_BAND = (1.5, 2.4)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACES = " \t\n\x0b\x0c\r"

_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, odd_chunks double, in_band boolean"


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeat_words(words: Words, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, how many words lie in ``k``-word windows found twice or more in it."""
    if not len(words.start):
        return np.zeros(words.n, np.int64)
    at = np.flatnonzero(words.whole(k))
    key = mix(words.grams(words.hashes(), k)[at] + mix(words.doc[at].astype(np.uint64) + U64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + k, -1)
    return _per_text(np.cumsum(step[:-1]) > 0, words.first)


def dup_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            n += line in seen
            seen.add(line)
    return n


def compression(raw: bytes, codec: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole-text ratio, share of whole chunks outside the chunk band, and whether both are acceptable."""
    if not raw:
        return 0.0, 0.0, False
    ratio = len(raw) / len(codec.compress(raw))
    low, high = next((a, b) for size, a, b in BANDS if len(raw) <= size)
    chunks = [raw[i : i + CHUNK] for i in range(0, len(raw) - CHUNK + 1, CHUNK)] if len(raw) >= 2 * CHUNK else []
    odd = [not CHUNK_BAND[0] <= len(c) / len(codec.compress(c)) <= CHUNK_BAND[1] for c in chunks]
    share = sum(odd) / len(odd) if odd else 0.0
    return ratio, share, low <= ratio <= high and share <= 0.25


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
    for batch in batches:
        for low, high in slices(batch["text"]):
            texts = batch["text"].slice(low, high - low)
            words = Words(texts, NON_SPACE, lower=False)
            values = [t or "" for t in texts.to_pylist()]
            packed = [compression(t.encode(), codec) for t in values]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(low, high - low).cast(pa.int64()),
                    pa.array(words.count.astype(np.int64)),
                    pa.array(_per_text(words.inside & ((words.buf & 0xC0) != 0x80), words.text_at).astype(np.int64)),
                    pa.array(_per_text(_SYMBOL[words.buf], words.text_at).astype(np.int64)),
                    pa.array([dup_lines(t) for t in values], pa.int64()),
                    pa.array(repeat_words(words).astype(np.int64)),
                    pa.array([p[0] for p in packed], pa.float64()),
                    pa.array([p[1] for p in packed], pa.float64()),
                    pa.array([p[2] for p in packed], pa.bool_()),
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "odd_chunks", "in_band"],
            )


def measure(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the base counts, the ratios and the verdict."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return source.mapInArrow(_measure, _SCHEMA).withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("in_band")).drop("in_band")


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        low = 0
        for part in _measure(iter([pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch["text"]], names=["doc_id", "text"])])):
            n, repeated, in_band = (part[c].to_numpy(zero_copy_only=False) for c in ("n_words", "n_repeat_words", "in_band"))
            good = (n >= MIN_WORDS) & (100 * repeated <= 20 * n) & in_band
            yield batch.slice(low, len(part)).filter(pa.array(good))
            low += len(part)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, in one pass without a shuffle."""
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(_passing, docs.withColumn("text", F.col("text").cast("string")).schema)
