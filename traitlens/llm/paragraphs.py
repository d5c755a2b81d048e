"""Substring dedup (operator 4): paragraph MinHash banding.

Units are the lines of a text with at least ``MIN_WORDS`` words.  Each gets a MinHash signature of its 5-word shingles
(lower-cased A-Z, white-space words); colliding units are compared on their full shingle sets and linked at a Jaccard
similarity of 0.75 or more; of every component of linked units the first occurrence (least doc_id, then position) stays
and the others are removed.  ``tune`` chooses the bands for a wanted recall.

Passages do not depend on line breaks: of every 25 consecutive 26-word grams of the whole text's words the one with the
least hash is kept, so a run of 50 equal words, in the middle of longer lines or wrapped over short ones, holds a kept
gram on all sides, and the kept grams of a longer one leave no gap.  Grams with the same 96-bit digest are repeats, and the
first occurrence (same order) stays; digests of unlike grams meet in one of 2**96 pairs.  A passage is the words under
repeated grams; up to 24 words of a shared run may lie outside, or be kept with another first occurrence, at either end.
Passages and long lines are counted apart, and words may be in both.  A very common gram is dealt over many tasks.

Lost are repeated lines of fewer than ``MIN_WORDS`` words that are not part of a repeated run of ``PASSAGE`` words.

Defined results: null, empty and word-less texts have no units; every input row gives one row, repeated rows included
(a repeated row's units are repeats of the first row's); rows without doc_id take part and come last in the order of
occurrences.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import ROWS, split_join
from ..session import cut_lineage
from .decontaminate import winnow
from .linking import link, shingle_sets
from .superminhash import band_keys
from .textvec import NON_SPACE, U64, Words, mix, slices

PERCENT = 75
MIN_WORDS = 20
MISS = 1e-4
# Any run of PASSAGE equal words holds SPAN grams of GRAM words; kept grams are at most SPAN words apart and overlap.
PASSAGE = 50
GRAM = 26
SPAN = PASSAGE - GRAM + 1


def tune(threshold: float, miss: float, rows: int = 2) -> int:
    """Bands of ``rows`` positions so that a pair at the threshold shares none with probability at most ``miss``."""
    return int(np.ceil(np.log(miss) / np.log(1 - threshold**rows)))


# Two rows a band: unlike paragraphs share hardly any shingle, so short bands collide rarely and few are needed.
BAND_ROWS = 2
BANDS = tune(PERCENT / 100, MISS, BAND_ROWS)
_RNG = np.random.Generator(np.random.PCG64(7))
_A = _RNG.integers(1, 1 << 62, BANDS * BAND_ROWS, dtype=np.uint64) * U64(2) + U64(1)
_B = _RNG.integers(1, 1 << 62, BANDS * BAND_ROWS, dtype=np.uint64)


def minhash(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``uint32[n, M]`` signatures of the non-empty sets ``keys[first[i]:first[i+1]]``."""
    out = np.empty((len(first) - 1, len(_A)), np.uint32)
    if len(first) > 1:
        found = np.empty_like(keys)
        for j in range(len(_A)):
            np.multiply(keys, _A[j], out=found)
            found += _B[j]
            out[:, j] = np.minimum.reduceat(found, first[:-1]) >> U64(32)
    return out


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Long lines of the texts: the lines, their text, their position in it, and their words."""
    lines, owner, at = [], [], []
    for i, text in enumerate(texts.to_pylist()):
        for j, line in enumerate((text or "").split("\n")):
            if len(line) >= 2 * MIN_WORDS - 1:
                lines.append(line), owner.append(i), at.append(j)
    array = pa.array(lines, pa.string())
    words = Words(array, NON_SPACE, lower=True).count
    long = words >= MIN_WORDS
    return array.filter(pa.array(long)), np.array(owner, np.int64)[long], np.array(at, np.int64)[long], words[long]


def _identify(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit name of each set."""
    return np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)


def _named(lines: pa.Array) -> np.ndarray:
    """64-bit name of each line's text, by which the lines to compare are fetched."""
    return np.array([xxhash.xxh3_64_intdigest(t) for t in lines.to_pylist()], np.uint64).view(np.int64)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept grams of the texts: their text, word position in it, and two digests of their words."""
    words = Words(texts, NON_SPACE, lower=True)
    hashed = words.hashes()
    grams = words.grams(hashed, GRAM)
    at = winnow(grams, words.whole(PASSAGE)[: max(0, len(grams) - SPAN + 1)], SPAN)
    other = words.grams(mix(hashed ^ U64(0x5851F42D4C957F2D)), GRAM)[at] >> U64(33)
    owner = words.doc[at]
    return owner, (at - words.first[owner]).astype(np.int32), mix(grams[at]).view(np.int64), other.astype(np.int32)


_UNITS = "uid long, doc_id long, at long, n_words long, id long, line long, n long, sketch binary, bands array<long>, grams array<struct<word: int, g1: bigint, g2: int>>"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per long line, and a row with null ``id`` and the kept grams for every text."""
    uid = TaskContext.get().partitionId() << 40
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 20):
            texts, ids = batch["text"].slice(low, high - low), batch["doc_id"].slice(low, high - low).cast(pa.int64())
            lines, owner, at, words = _units(texts)
            sets = shingle_sets(lines)
            size = np.array([len(s) for s in sets], np.int64)
            sig = minhash(np.concatenate([np.zeros(0, np.uint64), *sets]), np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
            keys = band_keys(sig, BAND_ROWS).view(np.int64)
            n = len(texts)
            none = pa.nulls(n)
            columns = [
                (np.arange(uid, uid + n), owner + uid, pa.int64()),
                (ids, ids.take(pa.array(owner)), pa.int64()),
                (none, at, pa.int64()),
                (none, words, pa.int64()),
                (none, _identify(sets), pa.int64()),
                (none, _named(lines), pa.int64()),
                (none, size, pa.int64()),
                (none, [row.tobytes() for row in sig.astype(np.uint8)], pa.binary()),
            ]
            arrays = [pa.concat_arrays([pa.array(x).cast(t), pa.array(y, t)]) for x, y, t in columns]
            offsets = np.concatenate([np.zeros(n, np.int32), np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]])
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())))
            owner, *fields = _grams(texts)
            ends = np.concatenate([np.searchsorted(owner, np.arange(n + 1)), np.full(len(sets), len(owner))]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(f) for f in fields], names=["word", "g1", "g2"])))
            yield pa.RecordBatch.from_arrays(arrays, names=["uid", "doc_id", "at", "n_words", "id", "line", "n", "sketch", "bands", "grams"])
            uid += n


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct long line of the batch with its name."""
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 20):
            lines = _units(batch["text"].slice(low, high - low))[0]
            names, at = np.unique(_named(lines), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), lines.take(pa.array(at))], names=["line", "text"])


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per occurrence of a long line: uid, doc_id, at, n_words, cluster size and spread, and whether it is removed.

    Rows with null ``at`` stand for the texts themselves, one per row of ``docs``.
    """
    source = _source(docs)
    return _repeated(source, _profiled(source), percent)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _profiled(source: DataFrame) -> DataFrame:
    return cut_lineage(source.mapInArrow(_profile, _UNITS), "units", "zstd")


def _repeated(source: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid", "at")
    own = units.where("id is not null")
    items = cut_lineage(
        own.groupBy("id").agg(
            F.min("line").alias("line"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count("*").alias("size"),
            F.min(place).alias("first"), F.min("uid").alias("low"), F.max("uid").alias("high"),
        ),
        "items",
    )

    def fetch(ids: DataFrame) -> DataFrame:
        lines = source.select("text").mapInArrow(_lines, "line long, text string")
        return lines.join(items.select("id", "line").join(ids, "id", "left_semi"), "line").groupBy("id").agg(F.min("text").alias("text"))

    named = cut_lineage(items.select("id", "size", "first", "low", "high").join(link(items.select("id", "n", "sketch", "bands"), fetch, percent), "id"), "named")
    clusters = named.groupBy("comp").agg(
        F.sum("size").alias("size"), F.min("first").alias("first"), (F.min("low") != F.max("high")).alias("across")
    ).where("size > 1")
    found = cut_lineage(named.select("id", "comp").join(clusters, "comp"), "clusters")
    return units.select("uid", "doc_id", "at", "n_words", "id").join(found, "id", "left").select(
        "uid", "doc_id", "at", "n_words", F.col("size"), F.coalesce("across", F.lit(False)).alias("across"), F.col("first.doc_id").alias("first_doc_id"),
        F.coalesce((F.col("first.uid") != F.col("uid")) | (F.col("first.at") != F.col("at")), F.lit(False)).alias("removed"),
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word spans under the grams of each text: how many across documents, their words, and the removed spans."""
    for batch in batches:
        rows = []
        for hits in batch["hits"].to_pylist():
            spans: list[list[list[int]]] = []
            for flag in ("across", "removed"):
                found: list[list[int]] = []
                for word in sorted(h["word"] for h in hits if h[flag]):
                    if found and word <= found[-1][1]:
                        found[-1][1] = word + GRAM
                    else:
                        found.append([word, word + GRAM])
                spans.append(found)
            across, removed = spans
            rows.append((len(across), sum(b - a for a, b in across), sum(b - a for a, b in removed), [{"start": a, "end": b} for a, b in removed]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays(
            [batch["uid"], *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)), batch["passage_doc_ids"]],
            names=["uid", "n_passages", "passage_words", "removed_passage_words", "removed_passages", "passage_doc_ids"],
        )


def repeated_passages(units: DataFrame) -> DataFrame:
    """One row per text of ``units`` with repeated grams: uid, the passages across documents, and the spans removed."""
    grams = units.where(F.size("grams") > 0).select("uid", "doc_id", F.explode("grams").alias("g")).select("uid", "doc_id", "g.word", F.struct("g.g1", "g.g2").alias("gram"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid", "word")
    repeated = cut_lineage(
        grams.groupBy("gram").agg(F.min(place).alias("first"), (F.min("uid") != F.max("uid")).alias("across"), F.count("*").alias(ROWS)).where(F.col(ROWS) > 1),
        "repeated",
    )
    hits = split_join(grams.drop("doc_id"), repeated.drop(ROWS), "gram", ["uid", "word"], counts=repeated.select("gram", ROWS))
    removed = (F.col("first.uid") != F.col("uid")) | (F.col("first.word") != F.col("word"))
    return (
        hits.groupBy("uid")
        .agg(F.collect_list(F.struct("word", "across", removed.alias("removed"))).alias("hits"),
             F.array_sort(F.collect_set(F.when(F.col("across"), F.col("first.doc_id")))).alias("passage_doc_ids"))
        .mapInArrow(_merge, "uid long, n_passages long, passage_words long, removed_passage_words long, "
                            "removed_passages array<struct<start: bigint, end: bigint>>, passage_doc_ids array<long>")
    )


def paragraph_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: its long lines, how many repeat across documents or are removed, and in whom they occur
    first; and the same of its passages, with the removed ones as word spans."""
    source = _source(docs)
    units = _profiled(source)
    rows = _repeated(source, units, percent)
    is_line = F.col("at").isNotNull()
    lines = rows.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        F.count(F.when(is_line, 1)).alias("n_paragraphs"),
        F.count(F.when(F.col("across"), 1)).alias("n_repeated"),
        F.sum(F.when(F.col("across"), F.col("n_words")).otherwise(0)).alias("repeated_words"),
        F.count(F.when(F.col("removed"), 1)).alias("n_removed"),
        F.sum(F.when(F.col("removed"), F.col("n_words")).otherwise(0)).alias("removed_words"),
        F.array_sort(F.collect_set(F.when(F.col("across"), F.col("first_doc_id")))).alias("first_doc_ids"),
    )
    none = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_passages", "passage_words", "removed_passage_words")]
    none += [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("removed_passages", "array<struct<start: bigint, end: bigint>>"), ("passage_doc_ids", "array<long>"))]
    return lines.join(repeated_passages(units), "uid", "left").select(*lines.columns[1:], *none)
