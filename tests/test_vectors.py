import numpy as np
import pytest
from pyspark.sql import functions as F

from traitlens.functions.vectors import cosine, dot, norm


IMPLS = pytest.mark.parametrize("impl", ["arrow", "native"])


@IMPLS
def test_cosine_matches_numpy(spark, impl):
    rng = np.random.default_rng(7)
    rows = [(rng.normal(size=16).astype(np.float32).tolist(), rng.normal(size=16).astype(np.float32).tolist()) for _ in range(50)]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    got = df.select(
        cosine("a", "b", impl=impl).alias("c"), dot("a", "b", impl=impl).alias("d"), norm("a", impl=impl).alias("n")
    ).collect()
    for (a, b), r in zip(rows, got):
        a64, b64 = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
        assert r.c == pytest.approx(a64 @ b64 / (np.linalg.norm(a64) * np.linalg.norm(b64)), abs=1e-12)
        assert r.d == pytest.approx(a64 @ b64, abs=1e-9)
        assert r.n == pytest.approx(np.linalg.norm(a64), abs=1e-12)


@IMPLS
def test_cosine_zero_vector_size_mismatch_and_null_are_null(spark, impl):
    df = spark.createDataFrame(
        [([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0, 3.0], [1.0, 2.0]), (None, [1.0, 2.0]), ([1.0, 0.0], [2.0, 0.0])],
        "a array<float>, b array<float>",
    )
    got = [r.c for r in df.select(cosine("a", "b", impl=impl).alias("c")).collect()]
    assert got[:3] == [None, None, None] and got[3] == pytest.approx(1.0)


def test_mixed_dimensions_in_one_batch(spark):
    rows = [([1.0] * d, [2.0] * d) for d in (1, 3, 3, 1024, 2)]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>").coalesce(1)
    got = [r.d for r in df.select(dot("a", "b", impl="arrow").alias("d")).collect()]
    assert got == [2.0, 6.0, 6.0, 2048.0, 4.0]


def test_cosine_with_precomputed_norms(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    out = df.select(cosine("a", "b", norm("a"), norm("b")).alias("c")).first().c
    assert out == pytest.approx(24 / 25)
    assert df.select(F.round(cosine("a", "a"), 12).alias("c")).first().c == 1.0
