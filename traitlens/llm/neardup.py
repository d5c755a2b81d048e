"""MinHash near-dedup (operator 6): SuperMinHash signatures, banding, exact verification, components.

Texts are lower-cased (A-Z) and split at white space; a document's set is its distinct 5-word shingles, or its whole
word sequence as one shingle when it has fewer words.  Documents with Jaccard similarity of at least 0.75 are linked.

A vertex is a set, known by its 128-bit digest and named by the number of one row that has it; doc_ids come in at the end.

Defined results: null, empty and word-less texts have no shingles and link with nothing (their component is their own
doc_id); repeated rows are one vertex; rows that share a doc_id are linked, whatever their texts; a row without doc_id
takes part and is named by its component.  A component without any doc_id has a null name, and one row of it is kept.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import split_join
from ..session import cut_lineage
from .linking import link, merged, shingle_sets
from .superminhash import band_keys, signatures
from .textvec import slices

PERCENT = 75
# 32 bands of 4 rows over 128 positions: a pair at 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BAND_ROWS = 4

_PROFILE = "row long, doc_id long, key string, n long, d1 long, d2 long, sketch binary, bands array<long>"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 20):
            sets = shingle_sets(batch["text"].slice(low, high - low))
            size = np.array([len(s) for s in sets], np.int64)
            first = np.concatenate([[0], np.cumsum(size)])
            sig = signatures(np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64), first)
            digest = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            d1 = np.array([d >> 64 for d in digest], np.uint64).view(np.int64)
            d2 = np.array([d & 0xFFFFFFFFFFFFFFFF for d in digest], np.uint64).view(np.int64)
            keys = band_keys(sig, BAND_ROWS).view(np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            sketch = pa.array([row.tobytes() for row in sig.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(low, high)), batch["doc_id"].slice(low, high - low), batch["key"].slice(low, high - low), pa.array(size), pa.array(d1), pa.array(d2), sketch, bands],
                names=["row", "doc_id", "key", "n", "d1", "d2", "sketch", "bands"],
            )
        row += len(batch)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``; see the module's notes."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", F.md5("text"))
    profile = cut_lineage(source.mapInArrow(_profile, _PROFILE), "profile")
    # Equal sets are one class (128-bit digest): its least doc_id, and the row that stands for it, one with that doc_id.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    classes = cut_lineage(profile.where("n > 0").groupBy("d1", "d2").agg(first).select("d1", "d2", F.col("first.doc_id").alias("name"), F.col("first.row").alias("id")), "classes")
    members = profile.join(classes.select(F.col("id").alias("row")), "row", "left_semi").select(F.col("row").alias("id"), "doc_id", "key", "n", "sketch", "bands")
    items = cut_lineage(members, "items")

    def fetch(ids: DataFrame) -> DataFrame:
        """A text of each class: of the rows that have it, those with the doc_id of the row that stands for it."""
        wanted = items.join(ids, "id", "left_semi").select("id", "key", F.col("doc_id").alias("named"))
        rows = source.withColumn("spread", F.monotonically_increasing_id())
        found = split_join(rows, wanted, "key", ["spread"]).where(F.col("doc_id").eqNullSafe(F.col("named")))
        return found.groupBy("id").agg(F.first("text").alias("text"))

    labels = link(items.select("id", "n", "sketch", "bands"), fetch, percent)
    # Classes that meet in a doc_id are linked too; with unique ids there are none.
    both = F.struct("d1", "d2")
    shared = profile.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(both).alias("low"), F.max(both).alias("high")).where("low != high")
    ends = split_join(profile.where("n > 0").select("doc_id", "row", "d1", "d2"), shared.select("doc_id", "low"), "doc_id", ["row"]).select("d1", "d2", "low").distinct()
    number = classes.select("d1", "d2", "id")
    pairs = ends.join(number, ["d1", "d2"]).select(F.col("id").alias("a"), F.col("low.d1").alias("d1"), F.col("low.d2").alias("d2")).join(number, ["d1", "d2"])
    pairs = cut_lineage(pairs.where("a != id").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct(), "shared")
    if pairs.limit(1).count():
        labels = merged(cut_lineage(labels, "labels"), pairs)

    named = cut_lineage(classes.join(labels, "id"), "labelled")
    names = named.groupBy("comp").agg(F.min("name").alias("component_id"))
    named = cut_lineage(split_join(named.select("id", "d1", "d2", "comp"), names, "comp", ["id"]).select("d1", "d2", "comp", "component_id"), "named")
    with_words = profile.where("n > 0").select("row", "doc_id", "n", "d1", "d2").join(named, ["d1", "d2"])
    # The row that gives an unnamed component its number is the one kept of it.
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull() & (F.col("row") == F.col("comp")))
    out = with_words.select("doc_id", "n", "component_id", kept.alias("kept"))
    without = profile.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(without).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")
