"""Toxicity (operator 2): class-conditional Kneser-Ney language models.

Both models spell words: the events are the bytes of a word (and its end) after up to ``ORDERS[0] - 1`` bytes of the same
word, its beginning included.  So an expression that was never seen whole is still judged by its stem, in any language.
The two longest orders have counts of their own class; they back off to shorter orders whose continuation counts both
classes share, so what neither class knows well gets nearly the same probability from both.  Discounts are the modified
Kneser-Ney ones, estimated per order; a word counts once per text.  A text's score is a logistic function of the
length-normalised difference of its two log-likelihoods and of the length-normalised part of it that single words owe to
more than ``MARGIN`` nats (which a shift of the class's language shares does not reach), fitted on labelled texts that the
counts have not seen.  No word counts for more than ``CLIP`` nats.

Bounds (documented parameters): counts come from at most ``PER_CLASS`` labelled texts of each class and the logistic fit from
at most ``CALIBRATE`` of each class, both chosen by a hash of doc_id; contexts and
events are hashed into ``SLOTS`` counters per order, so the broadcast model has 18 arrays of ``SLOTS`` floats (38 MB)
whatever the size of the corpus.  Every text is scored whole.

Rows whose ``crc32(doc_id as text) mod 5`` is 0 are never learnt from.  Labels, lang, source and doc_id are never inputs
of a score.

Defined results: null, empty and word-less texts have difference 0 and get the score of that; a document with several
labels is toxic if any says so, null labels are ignored; without labels every text gets the same score below 0.5;
every input row gives one row, with held_out false for a null doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textvec import ALNUM, U64, Words, mix, range_hashes, slices

PER_CLASS = 6000
CALIBRATE = 4000
ORDERS = (8, 5, 3, 1)  # bytes of an event with its context; the first OWN are class-conditional, the rest shared
OWN = 2
SLOTS = 1 << 19
MARGIN = 2.0
CLIP = 8.0


def _spelled(words: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per order the hashes of event and context of every byte of `` word ``, and the first event of each word."""
    if not len(words):
        none = np.zeros(0, np.uint64)
        return [(none, none) for _ in ORDERS], np.zeros(1, np.int64)
    side = pa.scalar(" ", pa.large_string())
    joined = pc.binary_join_element_wise(side, words.cast(pa.large_string()), side, pa.scalar("", pa.large_string()))
    off = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    buf = np.frombuffer(joined.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    inside = np.ones(len(buf), bool)
    inside[off[:-1]] = False  # the leading space is context only
    at = np.flatnonzero(inside)
    begin = np.repeat(off[:-1], np.diff(off) - 1)
    starts = [np.maximum(at - order + 1, begin) for order in ORDERS]
    pairs = [(range_hashes(buf, start, at + 1), range_hashes(buf, start, at)) for start in starts]
    return pairs, np.concatenate([[0], np.cumsum(np.diff(off) - 1)])


def _slot(hashed: np.ndarray) -> np.ndarray:
    return (hashed & U64(SLOTS - 1)).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 21):
            words = Words(batch["text"].slice(low, high - low), ALNUM, lower=True)
            toxic = np.repeat(batch["toxic"].to_numpy(zero_copy_only=False)[low:high], words.count)
            hashed = words.hashes()
            _, once = np.unique(mix(hashed + words.doc.astype(np.uint64)), return_index=True)
            _, at, n = np.unique(hashed[once] ^ toxic[once].astype(np.uint64), return_index=True, return_counts=True)
            at = once[at]
            yield pa.RecordBatch.from_arrays([pa.array(toxic[at]), words.strings(at).cast(pa.string()), pa.array(n)], names=["k", "word", "n"])


_HASHES = [f"{x}{order}" for order in ORDERS for x in ("e", "c")]


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs, first = _spelled(batch["word"])
        size = np.diff(first)
        arrays = [np.repeat(batch[c].to_numpy(), size) for c in ("k", "n")]
        arrays += [x.view(np.int64) for pair in pairs for x in pair]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["k", "n", *_HASHES])


@dataclass
class Model:
    """Per order (longest first) and class: discounted counts by event slot, inverse totals and backoff weights by context slot."""

    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]
    weights: np.ndarray | None = None

    def word_differences(self, words: pa.Array) -> np.ndarray:
        """Log-likelihood difference (toxic - ordinary) of each word."""
        pairs, first = _spelled(words)
        slots = [(_slot(event), _slot(context)) for event, context in pairs]
        shared = np.full(len(slots[0][0]), 1 / 256, np.float32)
        for (event, context), tables in list(zip(slots, self.tables))[:OWN - 1:-1]:
            count, inverse, backoff = tables[0]
            shared = count[event] * inverse[context] + backoff[context] * shared
        logs = []
        for k in (0, 1):
            p = shared
            for (event, context), tables in list(zip(slots, self.tables))[OWN - 1::-1]:
                count, inverse, backoff = tables[k]
                p = count[event] * inverse[context] + backoff[context] * p
            logs.append(np.log(np.maximum(p, 1e-12)))
        total = np.concatenate([[0], np.cumsum(logs[1] - logs[0], dtype=np.float64)])
        return total[first[1:]] - total[first[:-1]]

    def differences(self, words: Words) -> np.ndarray:
        """Two numbers per text, means over its words: the difference, and its excess over the margin."""
        _, at, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        value = np.clip(self.word_differences(words.strings(at)), -CLIP, CLIP)
        out = []
        for v in (value, np.maximum(value - MARGIN, 0)):
            total = np.concatenate([[0], np.cumsum(v[which])])
            out.append((total[words.first[1:]] - total[words.first[:-1]]) / np.maximum(words.count, 1))
        return np.stack(out)


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more."""
    n = {r["n"]: r["many"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("many")).collect()}
    n1, n2, n3, n4 = (max(1, n.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.3), i + 0.98) for i, d in enumerate(raw)]


def estimate(words: DataFrame) -> Model:
    """Model from ``(k, word, n)`` counts, k 0 or 1."""
    types = "k long, n long, " + ", ".join(f"{h} long" for h in _HASHES)
    level = cut_lineage(
        words.mapInArrow(_events, types).groupBy("k", "e8").agg(F.sum("n").alias("n"), *(F.first(h).alias(h) for h in _HASHES if h != "e8")), "events"
    )
    tables = []
    for i, order in enumerate(ORDERS):
        event, context = f"e{order}", f"c{order}"
        if i:  # continuation counts: how many different longer events end in this one
            keys = ["k", event] if i < OWN else [event]
            rest = [h for h in _HASHES[2 * i :] if h != event]
            level = cut_lineage(level.groupBy(*keys).agg(F.count("*").alias("n"), *(F.first(h).alias(h) for h in rest)), "events")
        rows = level if i < OWN else level.withColumn("k", F.lit(0).cast("long"))
        d1, d2, d3 = _discounts(rows)
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)

        def dense(column: str, value) -> np.ndarray:
            """At most two classes times SLOTS rows reach the driver."""
            slot = F.col(column).bitwiseAND(F.lit(SLOTS - 1)).cast("int")
            table = rows.groupBy("k", slot.alias("slot")).agg(value.cast("float").alias("v")).toArrow()
            out = np.zeros((2, SLOTS), np.float32)
            out[table["k"].to_numpy(), table["slot"].to_numpy()] = table["v"].to_numpy()
            return out

        count, total, removed = dense(event, F.sum(F.col("n") - d)), dense(context, F.sum("n")), dense(context, F.sum(d))
        seen = total > 0
        inverse = np.where(seen, 1 / np.maximum(total, 1), 0).astype(np.float32)
        backoff = np.where(seen, removed * inverse, 1).astype(np.float32)
        tables.append([(count[k], inverse[k], backoff[k]) for k in ((0, 1) if i < OWN else (0,))])
    return Model(tables)


def _features(difference: np.ndarray, excess: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Constant, the two means, and the excess in units of its spread over texts of this length."""
    return np.stack([np.ones(len(n)), difference, 10 * excess, excess * np.sqrt(n)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


_MEASURES = "doc_id long, n_words long, difference double, excess double"


def _differences(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(model.value)
        for batch in batches:
            for low, high in slices(batch["text"], 1 << 22):
                words = Words(batch["text"].slice(low, high - low), ALNUM, lower=True)
                difference, excess = m.differences(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(low, high - low),
                        pa.array(words.count.astype(np.int64)),
                        pa.array(difference),
                        pa.array(excess),
                    ],
                    names=["doc_id", "n_words", "difference", "excess"],
                )

    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _remainder(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, calibrate: int = CALIBRATE) -> Model:
    """Counts and calibration from labelled rows whose remainder is not 0 (remainder 1 calibrates, the others are counted)."""
    spark = docs.sparkSession
    known = cut_lineage(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .select("doc_id", F.least("toxic", F.lit(1)).alias("toxic"), _remainder().alias("part")).where("part != 0"),
        "labels",
    )
    share = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def chosen(part, n: int) -> DataFrame:
        """At most ``n`` rows of each class, so the broadcast below is bounded."""
        parts = [known.where(part & (F.col("toxic") == k)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k in (0, 1)]
        return F.broadcast(parts[0].unionByName(parts[1]).select("doc_id", "toxic"))

    source = _source(docs)
    counting = F.col("part") != 1
    words = (
        source.join(chosen(counting, per_class), "doc_id").select("text", F.col("toxic").cast("long").alias("toxic"))
        .mapInArrow(_word_counts, "k long, word string, n long").groupBy("k", "word").agg(F.sum("n").alias("n"))
    )
    model = estimate(words)
    held = chosen(F.col("part") == 1, calibrate)
    rows = (
        source.join(F.broadcast(held.select("doc_id")), "doc_id").mapInArrow(_differences(spark.sparkContext.broadcast(model.tables)), _MEASURES)
        .join(held, "doc_id").groupBy("doc_id", "toxic")  # one row a chosen doc_id, however many rows share it
        .agg(*(F.avg(c).alias(c) for c in ("n_words", "difference", "excess"))).orderBy("doc_id").toArrow()
    )
    y = rows["toxic"].to_numpy().astype(np.float64)
    x = _features(*(rows[c].to_numpy().astype(np.float64) for c in ("difference", "excess", "n_words")))
    # Weights bring the chosen rows back to the classes' shares among all labelled rows.
    taken = [max(1.0, float((y == k).sum())) for k in (0, 1)]
    weight = np.where(y == 1, share.get(1, 0) / taken[1], share.get(0, 0) / taken[0])
    model.weights = fit_logistic(x, y, weight / max(weight.mean(), 1e-12)) if len(y) else np.array([-1.0, 0, 0, 0])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, difference, excess, held_out, score, predicted)``, one row per row of ``docs``."""
    handle = docs.sparkSession.sparkContext.broadcast(model.tables)
    found = _source(docs).mapInArrow(_differences(handle), _MEASURES)
    w = [float(v) for v in model.weights]
    z = F.lit(w[0]) + w[1] * F.col("difference") + F.col("excess") * (10 * w[2] + w[3] * F.sqrt("n_words"))
    value = 1 / (1 + F.exp(-z))
    return found.select(
        "doc_id",
        "n_words",
        "difference",
        "excess",
        F.coalesce(_remainder() == 0, F.lit(False)).alias("held_out"),
        value.alias("score"),
        F.when(value >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
