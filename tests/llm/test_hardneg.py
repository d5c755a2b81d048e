from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from traitlens.llm import hardneg, queries

SCHEMA = "vec_id long, label int, embedding array<float>, block long, chunk long, pos int, data string, ids int, score long, dim int, tie int, anchor string"


def frame(spark, rows, slices=4):
    extra = (7, 7, 7, "x", 7, 7, 7, 7, "x")
    return spark.createDataFrame(spark.sparkContext.parallelize([(*r, *extra) for r in rows], slices), SCHEMA)


def brute(rows, every=100, positives=5, negatives=5, low=80, high=100):
    good = []
    for vec_id, label, x in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        good.append((vec_id, label, [math.floor(256 * Fraction(float(np.float32(v)))) for v in x]))
    out = []
    for a_id, a_label, a in good:
        if a_id is None or a_id % every:
            continue
        near = [(sum(u * v for u, v in zip(a, x)), vec_id, label) for vec_id, label, x in good if vec_id != a_id and len(x) == len(a)]
        near.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for ps, p_id, _ in [r for r in near if r[2] == a_label][:positives]:
            inside = [r for r in near if r[2] != a_label and low * ps <= 100 * r[0] <= high * ps][:negatives]
            out += [(a_id, p_id, rank, n_id, ps, ns) for rank, (ns, n_id, _) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def clustered(rng, n, dim, labels=4):
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        x = centres[rng.integers(12)] + 0.25 * rng.normal(size=dim)
        rows.append((i, int(rng.integers(labels)), (x / np.linalg.norm(x)).astype(np.float32).tolist()))
    return rows


def test_equals_brute_force(spark, monkeypatch):
    for name, size in (("BLOCK", 32), ("CHUNK", 4), ("ZONES", 5)):
        monkeypatch.setattr(hardneg, name, size)
    rows = clustered(np.random.default_rng(4), 700, 6)
    got = hardneg.mine(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert result(got) == brute(rows, 20)
    assert result(hardneg.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, 2, 3, 50, 90)) == brute(rows, 50, 2, 3, 50, 90)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 16)
    rng = random.Random(2)
    x = lambda: [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)]  # noqa: E731  many ties
    rows: list = [(i, rng.randrange(3), x()) for i in range(120)]
    rows += [(200, None, [1.0, 0.0, 0.0]), (300, 1, None), (400, 1, [1.0, None, 0.0]), (500, 1, [float("nan"), 0.0, 0.0]), (600, 1, [float("inf"), 0.0, 0.0])]
    rows += [(None, 1, [1.0, 1.0, 1.0]), (None, 2, [1.0, 1.0, 1.0]), (700, 2, [0.0, 0.0, 0.0]), (800, 2, [-1.0, -1.0, -1.0]), (900, 9, [1.0, 0.5, 1.0])]
    rows += [(0, 0, [1.0, 1.0, 0.5])] + [(5, 1, [1.0, 1.0, 0.5])] * 3  # a vec_id with two vectors; repeated rows
    rows += [(1000, 1, [0.5, 0.5]), (1001, 1, [0.5, 0.25]), (1002, 2, [0.5, 0.25]), (1100, 1, []), (1101, 1, []), (1102, 2, [])]
    rows += [(1200, 3, [3000.0, 2000.0, -1000.0, 1.0]), (1201, 3, [3000.0, 2000.0, -999.0, 1.0]), (1202, 4, [2900.0, 2000.0, -999.0, 1.0])]
    assert result(hardneg.mine(frame(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)
    assert hardneg.mine(frame(spark, rows).limit(0), F.lit(True)).collect() == []


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK", 64)
    rows = clustered(np.random.default_rng(8), 600, 4)
    rows += [(1000 + i, 1, rows[0][2]) for i in range(300)]
    assert result(hardneg.mine(frame(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(1 << 28), 1 << 28, (5, 40)), rng.integers(-(1 << 28), 1 << 28, (7, 40))
    exact = [[sum(int(u) * int(v) for u, v in zip(x, y)) for y in b] for x in a]
    assert hardneg.scores(a, b).tolist() == exact
    least, most = hardneg.bounds(a, b.min(axis=0)[None], b.max(axis=0)[None])
    assert (least[:, 0] <= np.min(exact, axis=1)).all() and (most[:, 0] >= np.max(exact, axis=1)).all()


def test_hilbert_curve_visits_neighbours():
    for dim, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), axis=-1).reshape(-1, dim)
        order = sorted(range(len(cells)), key=lambda i: hardneg.hilbert(cells, bits)[i].tobytes())
        steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_zone_maps_exclude_blocks(spark, monkeypatch):
    for name, size in (("BLOCK", 32), ("CHUNK", 4), ("ZONES", 5)):
        monkeypatch.setattr(hardneg, name, size)
    rng = np.random.default_rng(9)
    rows = [(i, int(i % 2), (np.eye(6)[i // 60] + 0.02 * rng.normal(size=6)).astype(np.float32).tolist()) for i in range(360)]
    blocks = hardneg.blocks_of(frame(spark, rows), F.col("vec_id") % 20 == 0)
    zones = blocks.select("block", "dim", "label", "low", "high").mapInArrow(hardneg._zone_rows, hardneg._ZONE_ROWS)
    chunks = blocks.where(F.size("anchors") > 0).select("dim", "label", "ids", "data", "anchors", "least").mapInArrow(hardneg._chunks, hardneg._CHUNKS)
    asked = chunks.crossJoin(zones.drop("dim")).mapInArrow(hardneg._ask_positives, hardneg._ASKED_POSITIVES)
    all_pairs = 18 * blocks.count() // 2  # anchors times blocks of their label
    assert 0 < asked.select(F.sum(F.size("pos"))).first()[0] < 0.6 * all_pairs
    assert result(hardneg.mine(frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute(rows, 20)


def test_query_columns(spark):
    got = queries.op12_hard_negatives(spark, "/root/testdata/sf0.001")
    assert got.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
