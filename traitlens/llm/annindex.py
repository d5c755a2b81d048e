"""Approximate nearest neighbours by cosine (operator 13): robust-pruned directed graphs, one per shard, searched by beam.

Rows are dealt evenly over shards of about ``SHARD`` rows.  A task builds the graph of its shard by adding nodes in batches
that grow with the graph: a greedy beam search from the entry (the node nearest the mean) proposes neighbours; relaxed
pruning takes the nearest proposal and drops every other one c with ALPHA * |taken, c| <= |node, c|, until ``DEGREE`` edges
are chosen; edges are also laid backwards, and a node with too many is pruned again.  A second pass over all nodes renews
the edges on the whole graph.  Every row is indexed, none sampled; equal vectors of a shard are one node with all its ids.

A query, in chunks of ``QUERIES``, is searched in every shard; the nodes of its last beam are scored again in double
precision on the original vectors, and the best of all shards win.  A task holds one shard and one chunk at a time; chunks
and shards meet in a merge join, whatever the size of their files, so the driver holds none of them.
Recall against brute force is measured in the tests and the README.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, neither as queries;
vectors are compared with those of their own length only.  A row with the query's vec_id is the query's own.  Repeated
rows count as often as they occur, as queries too.  A null vec_id comes last among ties.  An empty table gives no rows.
Other columns are ignored.  The order in which a shard's nodes are added is fixed by the shard's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SHARD = 8192
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
BEAM = 128
WIDTH = 4  # nodes of a beam that are expanded in one step
STEP = 1 << 15  # components of the nodes that are searched or pruned at once
QUERIES = 256

_ROWS = "vec_id long, dim int, query boolean, data binary"
_SHARDS = "part int, dim int, ids array<long>, first array<int>, data binary, graph binary, entry int"
_CHUNKS = "chunk long, chunk_dim int, query_ids array<long>, queries binary"
_FOUND = "chunk long, pos int, query_id long, vec_id long, score double"


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` scaled by powers of two (exactly) to components of at most 1, so that squares stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` (n x d) with its own rows of ``b`` (n x m x d), in double precision."""
    norm = lambda v: np.sqrt(np.einsum("...d,...d->...", v, v))
    return np.einsum("nd,nmd->nm", a, b) / (norm(a)[:, None] * norm(b))


class Graph:
    """Directed graph over unit vectors ``x`` (n x d, single precision): ``edges`` (n x degree, -1 where none) and ``entry``."""

    def __init__(self, x: np.ndarray, edges: np.ndarray, entry: int):
        self.x, self.edges, self.entry = x, edges, entry

    def step(self) -> int:
        return max(16, STEP // max(self.x.shape[1], 1))

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 where none) and distances of the ``beam`` nearest nodes met by greedy searches for the rows of ``q``."""
        n, rows = len(self.x), len(q)
        ids, dist = np.full((rows, beam), -1, np.int32), np.full((rows, beam), np.inf, np.float32)
        done = np.ones((rows, beam), bool)
        ids[:, 0], dist[:, 0], done[:, 0] = self.entry, 1 - q @ self.x[self.entry], False
        met = np.zeros((rows, n), bool)
        met[:, self.entry] = True
        live = np.arange(rows)
        while len(live):
            fresh = ~done[live]
            some = fresh.any(axis=1)
            live, fresh = live[some], fresh[some]
            if not len(live):
                break
            row, at = np.nonzero(fresh & (np.cumsum(fresh, axis=1) <= WIDTH))
            done[live[row], at] = True
            near = self.edges[ids[live[row], at]]
            key = np.unique((row[:, None] * n + near)[near >= 0])
            who, node = key // n, key % n
            new = ~met[live[who], node]
            who, node = who[new], node[new]
            met[live[who], node] = True
            count = np.bincount(who, minlength=len(live))
            slot = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            width = int(count.max(initial=0))
            if not width:
                continue
            more, far = np.full((len(live), width), -1, np.int32), np.full((len(live), width), np.inf, np.float32)
            more[who, slot] = node
            far[who, slot] = 1 - np.einsum("nd,nd->n", q[live[who]], self.x[node])
            all_ids, all_dist = np.concatenate([ids[live], more], axis=1), np.concatenate([dist[live], far], axis=1)
            all_done = np.concatenate([done[live], more < 0], axis=1)
            best = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_dist, best, axis=1), axis=1, kind="stable"), axis=1)
            for whole, part in ((ids, all_ids), (dist, all_dist), (done, all_done)):
                whole[live] = np.take_along_axis(part, best, axis=1)
        return ids, dist

    def prune(self, nodes: np.ndarray, near: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of ``nodes`` chosen from the proposals ``near`` (-1 where none): the nearest first, then what no chosen one covers."""
        degree, out = self.edges.shape[1], np.full((len(nodes), self.edges.shape[1]), -1, np.int32)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[near == nodes[:, None]] = -1
        dist = 2 - 2 * np.einsum("nd,nmd->nm", self.x[nodes], self.x[near])
        dist[near < 0] = np.inf
        keep = min(near.shape[1], 4 * degree)
        order = np.argsort(dist, axis=1, kind="stable")[:, :keep]
        near, dist = np.take_along_axis(near, order, axis=1), np.take_along_axis(dist, order, axis=1)
        around = self.x[near]
        apart = 2 - 2 * around @ around.transpose(0, 2, 1)
        alive, at = near >= 0, np.arange(len(nodes))
        for edge in range(degree):
            first = alive.argmax(axis=1)
            has = alive[at, first]
            if not has.any():
                break
            out[has, edge] = near[at, first][has]
            alive &= alpha * alpha * np.maximum(apart[at, first], 0) > dist
            alive[at, first] = False
        return out

    def link(self, nodes: np.ndarray, beam: int, alpha: float) -> None:
        """Find and lay the edges of ``nodes``, and the edges back."""
        found, _ = self.search(self.x[nodes], beam)
        self.edges[nodes] = self.prune(nodes, np.concatenate([found, self.edges[nodes]], axis=1), alpha)
        start, end = np.repeat(nodes, self.edges.shape[1]), self.edges[nodes].ravel()
        start, end = start[end >= 0], end[end >= 0]
        order = np.argsort(end, kind="stable")
        start, end = start[order], end[order]
        target, count = np.unique(end, return_counts=True)
        slot = np.arange(len(end)) - np.repeat(np.cumsum(count) - count, count)
        back = np.full((len(target), int(count.max(initial=0))), -1, np.int32)
        back[np.repeat(np.arange(len(target)), count), slot] = start
        degree = self.edges.shape[1]
        joined = np.concatenate([self.edges[target], back], axis=1)
        step = self.step()
        for low in range(0, len(target), step):
            part = slice(low, low + step)
            both = np.sort(joined[part], axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            fits = (both >= 0).sum(axis=1) <= degree
            room = -np.sort(-both, axis=1)[:, :degree]
            if not fits.all():
                room[~fits] = self.prune(target[part][~fits], both[~fits], alpha)
            self.edges[target[part]] = room


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> Graph:
    """The graph of unit vectors ``x``."""
    n = len(x)
    entry = int(np.argmax(x @ x.mean(axis=0)))
    graph = Graph(x, np.full((n, degree), -1, np.int32), entry)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[entry], order[order != entry]]).astype(np.int64)
    first = order[: min(n, degree + 1)]
    for i in first:  # the first nodes know each other
        others = first[first != i]
        graph.edges[i, : len(others)] = others
    low = len(first)
    while low < n:
        batch = order[low : low + min(graph.step(), low)]
        graph.link(batch, beam, alpha)
        low += len(batch)
    for low in range(0, n if n > degree + 1 else 0, graph.step()):
        graph.link(order[low : low + graph.step()], beam, alpha)
    return graph


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.fill_null(pc.list_value_length(batch["embedding"]), 0).to_numpy(zero_copy_only=False)
        for dim in np.unique(size[size > 0]).tolist():
            at = np.flatnonzero(size == dim)
            x = batch["embedding"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            at, x = at[good], x[good].astype("<f8")
            part = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], pa.array(np.full(len(at), dim, np.int32)), part["query"], pa.array([v.tobytes() for v in x], pa.binary())],
                names=["vec_id", "dim", "query", "data"],
            )


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.strip().split(" ") for field in ddl.split(","))])


def _shard(part: int, dim: int, rows: list[tuple[bytes, int | None]]) -> pa.RecordBatch:
    """The index row of a shard: equal vectors are one node."""
    rows.sort(key=lambda r: (r[0], r[1] is None, r[1] or 0))
    first = [i for i, r in enumerate(rows) if not i or r[0] != rows[i - 1][0]]
    x = np.frombuffer(b"".join(rows[i][0] for i in first), "<f8").reshape(-1, dim)
    scaled = unit(x)
    graph = build((scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32))
    row = {"part": part, "dim": dim, "ids": [r[1] for r in rows], "first": [*first, len(rows)], "data": x.tobytes(), "graph": graph.edges.astype("<i4").tobytes(), "entry": graph.entry}
    return pa.RecordBatch.from_pylist([row], schema=_schema(_SHARDS))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of a partition: one shard for each vector length, more beyond twice ``SHARD`` rows."""
    part, held = TaskContext.get().partitionId(), {}
    for batch in batches:
        for dim, data, vec_id in zip(*(batch[c].to_pylist() for c in ("dim", "data", "vec_id"))):
            rows = held.setdefault(dim, [])
            rows.append((data, vec_id))
            if len(rows) >= 2 * SHARD:
                yield _shard(part, dim, held.pop(dim))
    for dim, rows in held.items():
        yield _shard(part, dim, rows)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held = TaskContext.get().partitionId() << 32, {}

    def chunk(dim: int) -> pa.RecordBatch:
        nonlocal number
        number += 1
        ids, data = zip(*held.pop(dim))
        return pa.RecordBatch.from_pylist([{"chunk": number, "chunk_dim": dim, "query_ids": ids, "queries": b"".join(data)}], schema=_schema(_CHUNKS))

    for batch in batches:
        for dim, data, vec_id in zip(*(batch[c].to_pylist() for c in ("dim", "data", "vec_id"))):
            held.setdefault(dim, []).append((vec_id, data))
            if len(held[dim]) == QUERIES:
                yield chunk(dim)
    for dim in list(held):
        yield chunk(dim)


def _search(k: int, beam: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x = unit(np.frombuffer(row["data"], "<f8").reshape(-1, row["dim"]))
                q = unit(np.frombuffer(row["queries"], "<f8").reshape(-1, row["dim"]))
                single = lambda v: (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
                graph = Graph(single(x), np.frombuffer(row["graph"], "<i4").reshape(len(x), -1), row["entry"])
                out: list[tuple] = []
                near, _ = graph.search(single(q), beam)
                for low in range(0, len(q), 64):
                    part = near[low : low + 64]
                    score = np.where(part >= 0, cosines(q[low : low + 64], x[part]), -np.inf)
                    for pos, nodes, found in zip(range(low, low + len(part)), part, score):
                        out += _best(row, pos, nodes[nodes >= 0], found[nodes >= 0], k)
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _schema(_FOUND))], schema=_schema(_FOUND))

    return search


def _best(row: dict, pos: int, nodes: np.ndarray, found: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` best rows of the nodes: higher score, then smaller id; a node's ids are in order, its own id left out."""
    own, out = row["query_ids"][pos], []
    ids = lambda node: islice((v for v in islice(row["ids"], row["first"][node], row["first"][node + 1]) if v is None or v != own), k)
    least = np.partition(found, len(found) - k - 1)[len(found) - k - 1] if len(found) > k + 1 else -np.inf
    for node, score in zip(nodes[found >= least].tolist(), found[found >= least].tolist()):
        out += [(row["chunk"], pos, own, v, score) for v in ids(node)]
    return sorted(out, key=lambda r: (-r[4], r[3] is None, r[3] or 0))[:k]


def index(embeddings: DataFrame, query: Column) -> tuple[DataFrame, DataFrame]:
    """The written index, one row per shard, and the written usable rows with the ``query`` condition's value."""
    source = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(query, F.lit(False)).alias("query")
    )
    rows = cut_lineage(source.mapInArrow(_usable, _ROWS), "vectors")
    shards = max(1, -(-rows.count() // SHARD))
    return cut_lineage(rows.select("vec_id", "dim", "data").repartition(shards).mapInArrow(_build, _SHARDS), "shards"), rows


def nearest(embeddings: DataFrame, query: Column, k: int = 5, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; see the module's notes.  ``embeddings`` has vec_id and embedding."""
    shards, rows = index(embeddings, query)
    chunks = cut_lineage(rows.where("query").select("vec_id", "dim", "data").mapInArrow(_chunks, _CHUNKS), "queries")
    parts = shards.select(F.max("part").alias("last")).first()["last"]
    everywhere = chunks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts or 0))))
    # The planner knows the size of the chunks' files, not that each chunk comes once a shard: without the hint it broadcasts them all.
    found = everywhere.join(shards.hint("merge"), "part").where("dim = chunk_dim").mapInArrow(_search(k, beam), _FOUND)
    order = Window.partitionBy("chunk", "pos").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
