"""Hard-negative mining (operator 12): Hilbert-ordered candidate blocks with zone maps.

Components become floor(scale * x); a score is the integer inner product with the anchor, higher first, ties by smaller
vec_id.  An anchor's positives are its first rows of the same label; for each positive, its negatives are the first rows
of other labels whose score lies in [low, high] percent of the positive's.

Method.  Rows are ordered by label and by the Hilbert curve through their directions, and written as Parquet blocks of at
most ``BLOCK`` rows of one label, each with the least and greatest value of every dimension.  For an anchor a, interval
arithmetic on a block's zone map bounds all its scores: sum over dimensions of max(a*low, a*high), and of min().  Anchors,
in chunks, ask only for blocks whose bounds reach what they look for:

1. the block that holds the anchor gives a first idea of its last positive's score (a lower bound);
2. positives are read from blocks of the label whose upper bound reaches that score;
3. negatives are read from blocks of other labels whose bounds meet the window of one of the positives.

Requests carry the anchors that asked and meet the block in a join by block number; every task holds one block and one
chunk at a time.  Blocks that cannot be excluded are read, so the result is exact whatever the data; in many dimensions
and without clusters few blocks are excluded but those of the wrong label.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part, nor do components
so large that a score may not fit a long (|floor(scale * x)| above sqrt(2^63 / dimensions) or 2^31); vectors are compared
with those of their own length only.  A row with the anchor's vec_id is no other row.  Repeated rows count as often as
they occur, as anchors too.  A null vec_id comes last among ties.  Negative positive scores leave an empty window.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK = 1024  # rows of a block
CHUNK = 256  # anchors of a chunk
ZONES = 256  # zone maps of a row of the zone table
BITS, KEY_BYTES = 4, 16  # of a coordinate on the curve; of the curve's number that rows are ordered by
ZERO = 0.4 * (1 << BITS) + 0.1  # place of zero among the cells
EXACT = float(1 << 53)

_ROWS = "dim int, label long, curve binary, vec_id long, tie long, anchor boolean, data binary"
_BLOCKS = "block long, dim int, label long, ids array<long>, data binary, low array<int>, high array<int>, anchors array<int>, least array<long>"
_CHUNKS = "chunk long, dim int, label long, ids array<long>, data binary, least array<long>"
_ZONE_ROWS = "dim int, blocks array<long>, labels array<long>, low binary, high binary"
_ASKED = "block long, chunk long, dim int, pos array<int>, data binary"


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bytes of the Hilbert curve's number of each row of ``cells`` (n x d integers below 2**bits), high bits first."""
    x = cells.T.astype(np.uint8)
    d, n = x.shape
    if not d:
        return np.zeros((n, 0), np.uint8)
    for level in range(bits - 1, 0, -1):
        high, rest = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for i in range(d):
            turned = (x[i] & high) != 0
            swap = np.where(turned, np.uint8(0), (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(turned, rest, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.uint8)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[d - 1] & np.uint8(1 << level), np.uint8((1 << level) - 1), np.uint8(0))
    x ^= flip
    planes = np.concatenate([(x.T >> np.uint8(level)) & np.uint8(1) for level in range(bits - 1, -1, -1)], axis=1)
    return np.packbits(planes, axis=1)


def _quantised(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tie = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch["embedding"]), -1).to_numpy(zero_copy_only=False)
            size = np.where(batch["label"].is_null().to_numpy(zero_copy_only=False), -1, size)
            for dim in np.unique(size[size >= 0]).tolist():
                at = np.flatnonzero(size == dim)
                flat = batch["embedding"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = flat.reshape(len(at), dim)
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(scale * x)
                    good = (np.isfinite(x) & (np.abs(whole) <= min(np.sqrt(float((1 << 63) - 1) / max(dim, 1)) - 1, float((1 << 31) - 1)))).all(axis=1)
                at, x, whole = at[good], x[good], whole[good].astype("<i4")
                if not len(at):
                    continue
                rms = np.sqrt((whole.astype(np.float64) ** 2).mean(axis=1, keepdims=True)) if dim else np.ones((len(at), 1))
                # Half a root mean square a cell; zero lies inside a cell, so that small noise does not decide the high bits.
                cells = np.clip(np.floor(whole / np.where(rms > 0, rms, 1) * (1 << BITS - 3) + ZERO), 0, (1 << BITS) - 1)
                curve = hilbert(cells)[:, :KEY_BYTES]
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), dim, np.int32)), part["label"], pa.array([c.tobytes() for c in curve], pa.binary()), part["vec_id"],
                     pa.array(tie + at), part["anchor"], pa.array([v.tobytes() for v in whole], pa.binary())],
                    names=["dim", "label", "curve", "vec_id", "tie", "anchor", "data"],
                )
            tie += batch.num_rows

    return rows


def _matrix(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i4").reshape(n, dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``."""
    reach = np.abs(a.astype(np.float64)).max(initial=0) * np.abs(b.astype(np.float64)).max(initial=0) * max(a.shape[1], 1)
    if reach < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that a row of ``a`` can have with a vector between ``low`` and ``high`` (interval arithmetic)."""
    a, low, high = (x.astype(np.float64) for x in (a, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    reach = np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(reach < EXACT / 4, 0, reach * 1e-12 + 2)  # what rounding may take from sums beyond 2**53
    return least - slack, most + slack


def _pack(positives: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of sorted rows, with their zone maps, and of each anchor the score of its last positive within the block."""

    def block(number: int, rows: pa.Table) -> dict:
        dim, label = rows["dim"][0].as_py(), rows["label"][0].as_py()
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("vec_id", "ascending"), ("tie", "ascending")]))  # nulls last
        data = b"".join(rows["data"].to_pylist())
        x, ids = _matrix(data, dim, len(rows)), rows["vec_id"].to_pylist()
        anchors = np.flatnonzero(rows["anchor"].to_numpy(zero_copy_only=False).astype(bool))
        least: list[int | None] = []
        for i, near in zip(anchors.tolist(), scores(x[anchors], x)):
            own = np.array([j for j, v in enumerate(ids) if v == ids[i]], np.int64)
            others = np.delete(near, own)
            least.append(int(np.partition(others, len(others) - positives)[len(others) - positives]) if len(others) >= positives else None)
        return {"block": number, "dim": dim, "label": label, "ids": ids, "data": data, "low": x.min(axis=0).tolist(), "high": x.max(axis=0).tolist(), "anchors": anchors.tolist(), "least": least}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            kind = np.stack([held["dim"].to_numpy().astype(np.int64), held["label"].to_numpy()])
            cut = np.concatenate([[0], np.flatnonzero((kind[:, 1:] != kind[:, :-1]).any(axis=0)) + 1, [len(held)]]) if len(held) else np.zeros(1, np.int64)
            done = 0
            for start, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
                while end - start >= BLOCK or (start < end and end < len(held)):
                    size = min(BLOCK, end - start)
                    yield _rows([block(number, held.slice(start, size))], _BLOCKS_ARROW)
                    number, start = number + 1, start + size
                    done = start
            held = held.slice(done)
        if held is not None and len(held):
            yield _rows([block(number, held)], _BLOCKS_ARROW)

    return pack


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.strip().split(" ") for field in ddl.split(","))])


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_BLOCKS_ARROW, _CHUNKS_ARROW, _ZONES_ARROW = _arrow(_BLOCKS), _arrow(_CHUNKS), _arrow(_ZONE_ROWS)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of blocks in chunks of one label."""
    number, held = TaskContext.get().partitionId() << 32, {}

    def chunk(key: tuple[int, int], rows: list[tuple]) -> pa.RecordBatch:
        nonlocal number
        number += 1
        ids, data, least = zip(*rows)
        return _rows([{"chunk": number, "dim": key[0], "label": key[1], "ids": ids, "data": b"".join(data), "least": least}], _CHUNKS_ARROW)

    for batch in batches:
        for row in batch.to_pylist():
            key, x = (row["dim"], row["label"]), _matrix(row["data"], row["dim"], len(row["ids"]))
            if key not in held:  # blocks come in order of their label
                yield from (chunk(k, rows) for k, rows in held.items() if rows)
                held = {key: []}
            for i, least in zip(row["anchors"], row["least"]):
                held[key].append((row["ids"][i], x[i].tobytes(), least))
                if len(held[key]) == CHUNK:
                    yield chunk(key, held.pop(key))
                    held[key] = []
    yield from (chunk(k, rows) for k, rows in held.items() if rows)


def _zone_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps, up to ``ZONES`` of one vector length in a row."""
    held: dict[int, list[dict]] = {}

    def row(dim: int) -> pa.RecordBatch:
        zones = held.pop(dim)
        flat = lambda c: np.array([z[c] for z in zones], "<i4").tobytes()
        return _rows([{"dim": dim, "blocks": [z["block"] for z in zones], "labels": [z["label"] for z in zones], "low": flat("low"), "high": flat("high")}], _ZONES_ARROW)

    for batch in batches:
        for zone in batch.to_pylist():
            held.setdefault(zone["dim"], []).append(zone)
            if len(held[zone["dim"]]) == ZONES:
                yield row(zone["dim"])
    for dim in list(held):
        yield row(dim)


_ASKED_POSITIVES = _ASKED + ", ids array<long>, least array<long>"
_ASKED_NEGATIVES = _ASKED + ", number array<int>, owner array<int>, floor array<long>, ceiling array<long>"


def _ask_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of an anchor's label whose upper bound reaches the last positive known."""
    schema = _arrow(_ASKED_POSITIVES)
    for batch in batches:
        for row in batch.to_pylist():
            a, low, high = _matrix(row["data"], row["dim"], len(row["ids"])), *(_matrix(row[c], row["dim"], len(row["blocks"])) for c in ("low", "high"))
            least = np.array([-np.inf if s is None else s for s in row["least"]])
            need = bounds(a, low, high)[1] >= least[:, None]
            asked = []
            for z, (block, label) in enumerate(zip(row["blocks"], row["labels"])):
                pos = np.flatnonzero(need[:, z]) if label == row["label"] else ()
                if len(pos):
                    asked.append({"block": block, "chunk": row["chunk"], "dim": row["dim"], "pos": pos.tolist(), "data": a[pos].tobytes(), "ids": [row["ids"][i] for i in pos], "least": [row["least"][i] for i in pos]})
            if asked:
                yield _rows(asked, schema)


def _ask_negatives(low_percent: int, high_percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of other labels whose bounds meet a window of an anchor."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_ASKED_NEGATIVES)
        for batch in batches:
            for row in batch.to_pylist():
                windows = [(w["pos"], w["number"], -(-low_percent * w["score"] // 100), high_percent * w["score"] // 100) for w in row["windows"]]
                windows = [w for w in windows if w[2] <= w[3]]
                if not windows:
                    continue
                a, low, high = _matrix(row["data"], row["dim"], len(row["ids"])), *(_matrix(row[c], row["dim"], len(row["blocks"])) for c in ("low", "high"))
                least, most = bounds(a, low, high)
                owner, number, floor, ceiling = (np.array(c) for c in zip(*windows))
                need = (most[owner] >= floor[:, None]) & (least[owner] <= ceiling[:, None])
                asked = []
                for z, (block, label) in enumerate(zip(row["blocks"], row["labels"])):
                    which = np.flatnonzero(need[:, z]) if label != row["label"] else ()
                    if len(which):
                        pos, local = np.unique(owner[which], return_inverse=True)
                        asked.append({"block": block, "chunk": row["chunk"], "dim": row["dim"], "pos": pos.tolist(), "data": a[pos].tobytes(),
                                      "number": number[which].tolist(), "owner": local.tolist(), "floor": floor[which].tolist(), "ceiling": ceiling[which].tolist()})
                if asked:
                    yield _rows(asked, schema)

    return ask


def _found(rows: list[tuple[int, int, int, int | None, int]]) -> pa.RecordBatch:
    chunk, pos, number, vec_id, score = zip(*rows) if rows else ((),) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(pos, pa.int32()), pa.array(number, pa.int32()), pa.array(vec_id, pa.int64()), pa.array(score, pa.int64())],
        names=["chunk", "pos", "number", "vec_id", "score"],
    )


def _read_positives(positives: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                near = scores(_matrix(row["data"], row["dim"], len(row["pos"])), _matrix(row["candidates"], row["dim"], len(row["candidate_ids"])))
                for i, (pos, own, least) in enumerate(zip(row["pos"], row["ids"], row["least"])):
                    order = np.argsort(-near[i], kind="stable")  # ties by vec_id: a block is in that order
                    taken = 0
                    for j in order.tolist():
                        if taken == positives or (least is not None and near[i, j] < least):
                            break
                        if row["candidate_ids"][j] != own:
                            out.append((row["chunk"], pos, 0, row["candidate_ids"][j], int(near[i, j])))
                            taken += 1
            yield _found(out)

    return read


def _read_negatives(negatives: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                near = scores(_matrix(row["data"], row["dim"], len(row["pos"])), _matrix(row["candidates"], row["dim"], len(row["candidate_ids"])))
                order = np.argsort(-near, axis=1, kind="stable")
                falling = -np.take_along_axis(near, order, axis=1)
                for number, i, floor, ceiling in zip(row["number"], row["owner"], row["floor"], row["ceiling"]):
                    first = int(np.searchsorted(falling[i], -ceiling))
                    for j in range(first, min(first + negatives, len(falling[i]))):
                        if -falling[i, j] < floor:
                            break
                        out.append((row["chunk"], row["pos"][i], number, row["candidate_ids"][order[i, j]], int(-falling[i, j])))
            yield _found(out)

    return read


def blocks_of(embeddings: DataFrame, anchor: Column, positives: int = 5, scale: int = 256) -> DataFrame:
    """The candidate blocks with their zone maps, as a written table."""
    source = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    rows = cut_lineage(source.mapInArrow(_quantised(scale), _ROWS), "rows")
    order = ["dim", "label", "curve", "vec_id", "tie"]
    parts = max(1, -(-rows.count() // (4 * BLOCK)))
    return cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_pack(positives), _BLOCKS), "blocks")


def mine(embeddings: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; see the module's notes.

    ``embeddings`` has vec_id, label and embedding; ``anchor`` is a condition on its columns.
    """
    blocks = blocks_of(embeddings, anchor, positives, scale)
    candidates = blocks.select("block", F.col("ids").alias("candidate_ids"), F.col("data").alias("candidates"))
    chunks = cut_lineage(blocks.where(F.size("anchors") > 0).select("dim", "label", "ids", "data", "anchors", "least").mapInArrow(_chunks, _CHUNKS), "chunks")
    zones = cut_lineage(blocks.select("block", "dim", "label", "low", "high").mapInArrow(_zone_rows, _ZONE_ROWS), "zones")
    # Every chunk meets every zone row of its vector length: zone rows are dealt over parts, chunks go to each part.
    parts = max(1, zones.count())
    dealt = zones.select(F.pmod(F.xxhash64("blocks"), F.lit(parts)).alias("part"), F.col("dim").alias("zone_dim"), "blocks", "labels", "low", "high")

    def at_zones(asking: DataFrame) -> DataFrame:
        everywhere = asking.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return everywhere.join(dealt, "part").where("dim = zone_dim")

    order = Window.partitionBy("chunk", "pos", "number").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    best = lambda rows, n: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    asked = at_zones(chunks).mapInArrow(_ask_positives, _ASKED_POSITIVES)
    found = asked.join(candidates, "block").mapInArrow(_read_positives(positives), _FOUND)
    first = cut_lineage(best(found, positives).select("chunk", "pos", F.col("rank").alias("number"), "vec_id", "score"), "positives")

    windows = first.groupBy("chunk").agg(F.collect_list(F.struct("pos", "number", "score")).alias("windows"))
    asked = at_zones(chunks.join(windows, "chunk")).mapInArrow(_ask_negatives(low_percent, high_percent), _ASKED_NEGATIVES)
    found = asked.join(candidates, "block").mapInArrow(_read_negatives(negatives), _FOUND)
    anchors = chunks.select("chunk", F.posexplode("ids").alias("pos", "anchor_id"))
    pairs = first.join(anchors, ["chunk", "pos"]).select("chunk", "pos", "number", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        best(found, negatives).join(pairs, ["chunk", "pos", "number"])
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


_FOUND = "chunk long, pos int, number int, vec_id long, score long"

MINE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      WHERE 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
