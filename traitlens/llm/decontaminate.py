"""Benchmark decontamination (operator 1): winnowed fingerprints, joined and extended to exact shared spans.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the texts after lower-casing A-Z.  A benchmark window is 13 consecutive
words of an item; an item of fewer words (but not none) is one window.

Winnowing: of every ``SPAN`` consecutive hashes of ``GRAM``-word grams the least is kept (the rightmost of equals).
``GRAM + SPAN - 1 = 13``, so any 13 shared words hold ``SPAN`` equal hashes on both sides and both keep the same one.
Documents and items are joined on kept fingerprints and every hit is extended word by word, so the result is exact.
Items shorter than 13 words are joined on the hash of the whole item and compared as text.

A bit table of ``FILTER_BITS`` bits (2 MB whatever the size of the benchmark) over the benchmark's fingerprints is the
only broadcast; document fingerprints outside it are not shuffled.  The join is salted against passages that a large
share of documents hold.

Defined results: null or word-less texts have no words and are clean; every input row gives one row, repeated rows and
rows with equal or null doc_id included; items without words never occur; items with a null id mark words as hit but are
not counted.  Other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textvec import ALNUM, U64, Words, mix, slices

WINDOW = 13
GRAM = 7
SPAN = WINDOW - GRAM + 1
FILTER_BITS = 1 << 24
SALTS = 8

_HIT = "struct<fp: bigint, at: bigint, width: bigint, words: string, lead: bigint>"


def winnow(grams: np.ndarray, whole: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Positions kept by winnowing; ``whole`` marks grams that stay inside their text (runs of one text are contiguous)."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at, width = grams, np.arange(len(grams)), 1
    while width < span:  # least grams of windows twice as long; the last two overlap
        step = min(width, span - width)
        at = np.where(least[step:] <= least[:-step], at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    at = at[whole]
    return at[np.flatnonzero(np.diff(at, prepend=-1))]  # windows of later positions do not keep earlier grams


def _context(words: Words, at: np.ndarray, width: int, margin: int) -> tuple[list[str], np.ndarray]:
    """The words from ``margin`` before to ``margin`` after each gram, within its text, and how many precede the gram."""
    own = words.doc[at]
    low, high = np.maximum(at - margin, words.first[own]), np.minimum(at + width + margin, words.first[own + 1])
    raw = words.buf.tobytes()
    out = []
    for a, b in zip(low.tolist(), high.tolist()):
        out.append(" ".join([raw[s:e].decode() for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist())]))
    return out, at - low


def _fingerprints(words: Words, lengths: list[int], keep) -> list[tuple]:
    """``(text, fingerprint, position, width, words, lead)`` of a slice: winnowed grams and whole short windows."""
    hashed = words.hashes()
    found = []
    for width in [GRAM, *lengths]:
        if width == GRAM:
            grams = words.grams(hashed, GRAM)
            at = winnow(grams, words.whole(WINDOW)[: max(0, len(grams) - SPAN + 1)])
            value, margin = mix(grams[at]), WINDOW - GRAM
        else:
            short = -width  # lengths of short items are negative so that they never meet winnowed grams
            grams = words.grams(hashed, short)
            at = np.flatnonzero(words.whole(short))
            value, margin, width = mix(grams[at] + U64(short)), 0, short
        ok = keep(value)
        at, value = at[ok], value[ok]
        text, lead = _context(words, at, width, margin)
        kind = width if margin else -width
        found += zip(words.doc[at].tolist(), value.view(np.int64).tolist(), (at - words.first[words.doc[at]]).tolist(), [kind] * len(at), text, lead.tolist())
    return found


def _benchmark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch["text"]):
            words = Words(batch["text"].slice(low, high - low), ALNUM, lower=True)
            short = sorted({int(n) for n in words.count if 0 < n < WINDOW})
            ids = batch["item_id"].slice(low, high - low).to_pylist()
            rows = [
                (ids[doc], fp, width, text, lead)
                for doc, fp, _, width, text, lead in _fingerprints(words, [-n for n in short], lambda v: np.ones(len(v), bool))
                if width == GRAM or words.count[doc] == -width
            ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item_id", "fp", "width", "item_words", "item_lead"), r)) for r in rows],
                schema=pa.schema([("item_id", pa.int64()), ("fp", pa.int64()), ("width", pa.int64()), ("item_words", pa.string()), ("item_lead", pa.int64())]),
            )


def _document_rows(table, lengths: list[int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint64)

        def keep(v: np.ndarray) -> np.ndarray:
            slot = v & U64(FILTER_BITS - 1)
            return (bits[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1

        uid = TaskContext.get().partitionId() << 40
        hit = pa.struct([("fp", pa.int64()), ("at", pa.int64()), ("width", pa.int64()), ("words", pa.string()), ("lead", pa.int64())])
        for batch in batches:
            for low, high in slices(batch["text"]):
                words = Words(batch["text"].slice(low, high - low), ALNUM, lower=True)
                hits: list[list[dict]] = [[] for _ in range(words.n)]
                for doc, fp, at, width, text, lead in _fingerprints(words, lengths, keep):
                    hits[doc].append({"fp": fp, "at": at, "width": width, "words": text, "lead": lead})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(uid, uid + words.n)),
                        batch["doc_id"].slice(low, high - low).cast(pa.int64()),
                        pa.array(words.count.astype(np.int64)),
                        pa.array(hits, pa.list_(hit)),
                    ],
                    names=["uid", "doc_id", "n_words", "hits"],
                )
                uid += words.n

    return rows


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared spans of at least a window around each joined fingerprint (equal text for short items)."""
    for batch in batches:
        uid, item, start, end = [], [], [], []
        for row in zip(*(batch[c].to_pylist() for c in ("uid", "at", "width", "words", "lead", "item_id", "item_words", "item_lead"))):
            u, at, width, ours, lead, i, theirs, item_lead = row
            ours, theirs = ours.split(" "), theirs.split(" ")
            if width < 0:
                if ours == theirs:
                    uid.append(u), item.append(i), start.append(at), end.append(at - width)
                continue
            if ours[lead : lead + width] != theirs[item_lead : item_lead + width]:
                continue
            left = right = 0
            while left < min(lead, item_lead) and ours[lead - left - 1] == theirs[item_lead - left - 1]:
                left += 1
            a, b = lead + width, item_lead + width
            while right < min(len(ours) - a, len(theirs) - b) and ours[a + right] == theirs[b + right]:
                right += 1
            if left + width + right >= WINDOW:
                uid.append(u), item.append(i), start.append(at - left), end.append(at + width + right)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (uid, item, start, end)], names=["uid", "item_id", "start", "end"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, item_ids (sorted as strings), and the hit word spans."""
    spark = docs.sparkSession
    index = cut_lineage(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _benchmark_rows, "item_id long, fp long, width long, item_words string, item_lead long"
        ).distinct(),
        "index",
    )
    # At most 12 lengths and FILTER_BITS / 64 words, whatever the size of the benchmark.
    lengths = sorted(r[0] for r in index.where("width < 0").select("width").distinct().collect())
    slot = F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    filled = index.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(fp & 63 as int))")).alias("mask")).toArrow()
    bits[filled["word"].to_numpy()] = filled["mask"].to_numpy()
    table = spark.sparkContext.broadcast(bits.tobytes())
    found = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _document_rows(table, lengths), f"uid long, doc_id long, n_words long, hits array<{_HIT}>"
        ),
        "hits",
    )
    hits = found.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("hit")).select("uid", "hit.*")
    salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spans = (
        hits.withColumn("salt", F.pmod(F.xxhash64("uid", "at"), F.lit(SALTS)).cast("int"))
        .join(salted, ["fp", "width", "salt"])
        .select("uid", "at", "width", "words", "lead", "item_id", "item_words", "item_lead")
        .mapInArrow(_extend, "uid long, item_id long, start long, end long")
        .groupBy("uid")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )
    covered = F.expr(
        "aggregate(array_sort(spans), named_struct('e', 0L, 't', 0L), (s, x) -> named_struct("
        "'e', greatest(s.e, x.end), 't', s.t + greatest(0L, x.end - greatest(s.e, x.start))), s -> s.t)"
    )
    no_items = F.array().cast("array<string>")
    return found.select("uid", "doc_id", "n_words").join(spans, "uid", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.array_sort("items"), no_items).alias("item_ids"),
        F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
    )


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, with ``contaminated`` where at least a twentieth of the words are hit."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


VERDICTS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bl) WHERE len(w) >= k)),
h AS (SELECT doc_id, item_id, dw.k, i FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
