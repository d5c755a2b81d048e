"""Exact similarity components over LSH buckets, without listing the pairs of a bucket.

Input: one row per vertex ``(id, n, sketch, bands)``: set size, one byte per signature position, band keys.

1. Each bucket (vertices sharing a band key) has two pivots: its least id and its least id by a hash that changes with
   the bucket, so a vertex meets different pivots in different bands.  Every member is compared with the first on the full
   shingle sets, and with the second unless the links so far join the two already.  That is linear in the bucket.
2. What is left are pairs of one bucket whose ends lie in different components.  Buckets where all other members are
   one component are done.  In the rest, members are dealt into slots of about ``BLOCK`` and compared slot by slot
   inside tasks, first by sketch (a margin of ``MARGIN`` standard errors below the threshold), then on full sets, so a
   hot bucket is spread over many small tasks and no pair that is not a link leaves a task.

No member, partner or bucket is ever dropped: the only loss is a pair that shares no band at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textvec import NON_SPACE, Words, slices

BLOCK = 1024
MARGIN = 5.0
SHINGLE = 5


def _distinct(x: np.ndarray) -> np.ndarray:
    """``np.unique`` of a non-empty array, without its cost per call."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of each text (lower-cased A-Z, white-space words).

    A text of fewer words has the whole sequence as its one shingle; without words the set is empty.
    """
    out: list[np.ndarray] = []
    for low, high in slices(texts):
        words = Words(texts.slice(low, high - low), NON_SPACE, lower=True)
        hashed = words.hashes()
        grams = words.grams(hashed, k)
        for i in range(words.n):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= k:
                out.append(_distinct(grams[a : b - k + 1]))
            else:
                out.append(words.grams(hashed[a:b], int(b - a))[:1])
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """``100 * |x & y| >= percent * |x | y|`` on sorted distinct hashes."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _ratio_ok(n, m, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _verifier(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, pivot_set = None, None
        for batch in batches:
            a, b = batch["a"].to_numpy(zero_copy_only=False), batch["b"].to_numpy(zero_copy_only=False)
            size = pc.add(pc.binary_length(batch["text_a"]), pc.binary_length(batch["text_b"])).to_numpy(zero_copy_only=False)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(size.astype(np.int64)) >> 22)) + 1, [len(a)]])
            keep = np.zeros(len(a), bool)
            for low, high in zip(cut[:-1], cut[1:]):
                sets = shingle_sets(batch["text_b"].slice(low, high - low))
                for i in range(low, high):
                    if pivot is None or a[i] != pivot:
                        pivot, pivot_set = a[i], shingle_sets(batch["text_a"].slice(i, 1))[0]
                    keep[i] = similar(pivot_set, sets[i - low], percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    return verify


def _close(block: pa.Table, percent: int):
    """For every member of the lower slot, the members of the upper slot (later ones of the same slot) that are of another
    component, of a size that allows a link, and alike by sketch."""
    sketch = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(len(block), -1)
    comp, n, slot = (block[c].to_numpy() for c in ("comp", "n", "slot"))
    width, t = sketch.shape[1], percent / 100
    least = width * (t - MARGIN * np.sqrt(t * (1 - t) / width))
    left, right = np.flatnonzero(slot == slot.min()), np.flatnonzero(slot == slot.max())
    for i in left:
        j = right[(comp[right] != comp[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent)]
        if slot[i] == slot.max():
            j = j[j > i]
        j = j[np.count_nonzero(sketch[j] == sketch[i], axis=1) >= least]
        if len(j):
            yield i, j


def _suspects(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Members of a block that have, by sketch, a possible partner in another component."""

    def find(block: pa.Table) -> pa.Table:
        hit = np.zeros(len(block), bool)
        for i, j in _close(block, percent):
            hit[i] = True
            hit[j] = True
        return block.filter(pa.array(hit))

    return find


def _block_links(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between different components of a block, each found component joined at once (a forest, not all links)."""

    def check(block: pa.Table) -> pa.Table:
        ids = block["id"].to_numpy()
        group = np.unique(block["comp"].to_numpy(), return_inverse=True)[1]
        sets = shingle_sets(block["text"].combine_chunks())
        a, b = [], []
        for i, near in _close(block, percent):
            for j in near:
                if group[i] != group[j] and similar(sets[i], sets[j], percent):
                    a.append(ids[i])
                    b.append(ids[j])
                    group[group == group[j]] = group[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return check


def components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` for every end of ``edges(a, b)``: the least id reachable.

    Each round takes the least label among the neighbours, then the label's own label; rounds grow with the logarithm
    of a component's diameter.  Labels are written to the shared folder after each step.
    """
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        least = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("m"))
        hooked = cut_lineage(labels.join(least, "id").select("id", F.least("comp", "m").alias("comp"), F.col("comp").alias("was")), "hooked")
        jump = hooked.select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        moved = cut_lineage(hooked.join(jump, "comp").select("id", F.col("to").alias("comp"), (F.col("to") != F.col("was")).alias("moved")), "labels")
        labels = moved.select("id", "comp")
        if moved.where("moved").limit(1).count() == 0:
            return labels


def _named(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``links(a, b)`` with the components of their ends."""
    ends = labels.select("id", "comp")
    return (
        links.join(ends.toDF("a", "ca"), "a", "left").join(ends.toDF("b", "cb"), "b", "left")
        .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    )


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels(id, comp)`` after further links, for all ids of either."""
    later = components(_named(links, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    old = labels.join(later.toDF("comp", "to"), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    return cut_lineage(old.unionByName(later.join(labels.select("id"), "id", "left_anti")), "labels")


def link(items: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """``(id, comp)`` for every row of ``items(id, n, sketch, bands)``.

    ``fetch(ids)`` returns ``(id, text)`` for the ids asked for; ``percent`` is the least Jaccard similarity of a link.
    """
    members = items.select("id", "n", F.explode("bands").alias("key"))
    own = F.struct("id", "n")
    buckets = cut_lineage(
        members.groupBy("key")
        .agg(F.min(own).alias("first"), F.min_by(own, F.struct(F.xxhash64("key", "id"), "id")).alias("second"), F.count("*").alias("size"))
        .where("size > 1"),
        "buckets",
    )
    inside = cut_lineage(members.join(buckets, "key"), "members")
    texts = cut_lineage(fetch(inside.select("id").distinct()), "texts")

    def pairs(pivot: str) -> DataFrame:
        p = F.col(pivot)
        near = inside.where((p["id"] != F.col("id")) & _ratio_ok(F.col("n"), p["n"], percent))
        return near.select(F.least("id", p["id"]).alias("a"), F.greatest("id", p["id"]).alias("b")).distinct()

    def verified(asked: DataFrame) -> DataFrame:
        return cut_lineage(
            asked.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b")
            .mapInArrow(_verifier(percent), "a long, b long"),
            "links",
        )

    first = components(verified(pairs("first")))
    # The second pivots only matter between components.
    asked = _named(pairs("second"), first).where("ca != cb").select("a", "b")
    first = merged(first, verified(asked))

    rest = cut_lineage(
        inside.where((F.col("id") != F.col("first.id")) & (F.col("id") != F.col("second.id")))
        .select("key", "id")
        .join(first, "id", "left")
        .select("key", "id", F.coalesce("comp", "id").alias("comp")),
        "rest",
    )
    split = cut_lineage(
        rest.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"))
        .where("low != high").select("key", F.ceil(F.col("size") / BLOCK).alias("slots")),
        "split",
    )
    dealt = (
        rest.join(split, "key")
        .withColumn("slot", F.pmod(F.xxhash64("id", "key"), "slots"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
        .select("key", F.least("slot", "other").alias("u"), F.greatest("slot", "other").alias("v"), "slot", "id", "comp")
        .join(items.select("id", "n", "sketch"), "id")
    )
    block = ["key", "u", "v"]
    fields = ["slot", "id", "comp", "n", "sketch"]
    suspects = cut_lineage(
        dealt.select(*block, *fields).groupBy(*block)
        .applyInArrow(_suspects(percent), "key long, u long, v long, slot long, id long, comp long, n long, sketch binary"),
        "suspects",
    )
    late = cut_lineage(
        suspects.join(texts, "id").select(*block, *fields, "text").groupBy(*block)
        .applyInArrow(_block_links(percent), "a long, b long"),
        "links",
    )
    return items.select("id").join(merged(first, late), "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))
