"""Product-local scores against a brute-force NumPy statement of the semantics."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from traitlens.operators import similarity
from traitlens.plans import fixtures as fx


def _entities(spark):
    return fx.entities_from_embeddings(fx.read_table(spark, SF_SMALL, "embeddings"))


def brute_force(rows):
    by = defaultdict(lambda: defaultdict(list))
    for r in rows:
        by[r.prd_id][r.prd_tag].append((r.id, np.array(r.embedding, dtype=np.float64)))
    cos = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    out = {}
    for pid, tags in by.items():
        if not all(tags.get(t) for t in ("product_name", "product_text", "product_image")):
            continue
        name = min(tags["product_name"])[1]
        text = min(tags["product_text"], key=lambda x: x[0])[1]
        out[pid] = (
            max(cos(name, v) for _, v in tags["product_text"]),
            max(cos(name, v) for _, v in tags["product_image"]),
            max(cos(text, v) for _, v in tags["product_image"]),
        )
    return out


def _scores(df):
    return {
        r.prd_id: (r.similarity_name_text, r.similarity_name_image, r.similarity_text_image) for r in df.collect()
    }


def test_scores_match_brute_force(spark):
    ent = _entities(spark)
    expected = brute_force(ent.collect())
    scores, rejects = similarity.similarity_inner(ent)
    got = _scores(scores)
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
        assert all(-1.0 <= s <= 1.0 for s in got[k])
    assert rejects.count() == 0


def test_salted_hot_key_path_gives_identical_scores(spark):
    ent = _entities(spark)
    plain, _ = similarity.similarity_inner(ent)
    salted, _ = similarity.similarity_inner(ent, hot_key_rows=2)  # every product is "hot"
    a, b = _scores(plain), _scores(salted)
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_one_product_holding_a_third_of_rows(spark):
    # Re-key a third of all entities onto one product: the plan must stay exact.
    ent = _entities(spark)
    hot = ent.withColumn("prd_id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("prd_id")))
    expected = brute_force(hot.collect())
    scores, _ = similarity.similarity_inner(hot, hot_key_rows=20)
    got = _scores(scores)
    assert set(got) == set(expected)
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_invariant_to_scaling_and_row_order(spark):
    ent = _entities(spark)
    base = _scores(similarity.similarity_inner(ent)[0])
    scaled = ent.withColumn("embedding", F.transform("embedding", lambda x: x * F.lit(3.5)))
    shuffled = scaled.orderBy(F.rand(3)).repartition(5)
    got = _scores(similarity.similarity_inner(shuffled)[0])
    for k in base:
        assert got[k] == pytest.approx(base[k], abs=1e-9)


def test_first_text_vector_is_lowest_id(spark):
    rows = [
        (1, "p", "product_name", [1.0, 0.0]),
        (5, "p", "product_text", [0.0, 1.0]),
        (3, "p", "product_text", [1.0, 0.0]),  # lowest text id -> query vector for text_image
        (7, "p", "product_image", [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "id long, prd_id string, prd_tag string, embedding array<float>")
    r = similarity.similarity_inner(df)[0].first()
    assert r.similarity_name_text == pytest.approx(1.0)  # max over both text vectors
    assert r.similarity_text_image == pytest.approx(1.0)  # first text (id 3) vs image


def test_missing_tag_is_a_reject_not_an_error(spark):
    rows = [
        (1, "ok", "product_name", [1.0, 0.0]),
        (2, "ok", "product_text", [1.0, 1.0]),
        (3, "ok", "product_image", [0.0, 1.0]),
        (4, "noimg", "product_name", [1.0, 0.0]),
        (5, "noimg", "product_text", [1.0, 0.0]),
        (6, "zero", "product_name", [0.0, 0.0]),
        (7, "zero", "product_text", [1.0, 0.0]),
        (8, "zero", "product_image", [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "id long, prd_id string, prd_tag string, embedding array<float>")
    scores, rejects = similarity.similarity_inner(df)
    assert [r.prd_id for r in scores.collect()] == ["ok"]
    assert sorted(r.prd_id for r in rejects.collect()) == ["noimg", "zero"]


def test_topk_max_equals_score_and_limit(spark):
    ent = _entities(spark)
    hits = similarity.topk_inner(ent, k=1)
    scores = _scores(similarity.similarity_inner(ent)[0])
    for r in hits.where("search = 'name_image'").collect():
        assert r.rank == 1
        assert r.similarity == pytest.approx(scores[r.prd_id][1], abs=1e-12)
    full = similarity.topk_inner(ent, k=10)
    per = full.groupBy("prd_id", "search").agg(F.max("rank").alias("m")).collect()
    assert all(r.m == (2 if r.search else 0) for r in per)


def test_topk_salted_equals_plain(spark):
    ent = _entities(spark)
    hot = ent.withColumn("prd_id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("prd_id")))
    cols = ["prd_id", "search", "rank", "id"]
    plain = sorted(tuple(r) for r in similarity.topk_inner(hot, k=4).select(*cols).collect())
    salted = sorted(tuple(r) for r in similarity.topk_inner(hot, k=4, hot_key_rows=10).select(*cols).collect())
    assert plain == salted
    assert max(r[2] for r in plain if r[0] == "HOT") == 4  # the limit is applied to the hot product too


def test_native_kernel_fills_missing_stored_norms(spark):
    import traitlens.functions.vectors as V

    rows = [
        (1, "p", "product_name", [1.0, 0.0], None),
        (2, "p", "product_text", [1.0, 1.0], 1.4142135623730951),
        (3, "p", "product_image", [0.0, 2.0], None),
    ]
    df = spark.createDataFrame(rows, "id long, prd_id string, prd_tag string, embedding array<float>, norm double")
    old = V.DEFAULT_IMPL
    V.DEFAULT_IMPL = "native"
    try:
        r = similarity.similarity_inner(df)[0].first()
    finally:
        V.DEFAULT_IMPL = old
    assert r.similarity_name_image == pytest.approx(0.0) and r.similarity_text_image == pytest.approx(2**-0.5)


def test_split_join_is_exact_and_broadcasts_at_most_a_key_per_partition(spark):
    from traitlens.operators.skew import PER_PARTITION, hot_keys, split_join

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', if(id % 50 = 1, null, cast(id % 97 as string))) as k", "id")
    small = big.select("k").distinct().selectExpr("k", "concat('v', k) as v")
    expected = sorted((k, i, "v" + k) for i in range(900) for k in ["hot" if i % 3 == 0 else None if i % 50 == 1 else str(i % 97)] if k)
    for rows in (None, 1, 10, 10_000):
        assert sorted(tuple(r) for r in split_join(big, small, "k", ["id"], rows).collect()) == expected
    hot = hot_keys(big, "k").collect()
    assert [r.k for r in hot] == ["hot"] and len(hot) <= parts
    assert sum(r._n_salt for r in hot) <= 2 * PER_PARTITION * parts
    assert split_join(big.limit(0), small, "k", ["id"]).collect() == []


def test_a_hot_product_is_split_on_a_session_without_extra_settings(spark):
    """Rows that each task of the scoring join holds, from the run itself; joins by shuffle, all tasks kept apart."""
    from traitlens.operators.similarity import _pair_frame
    from traitlens.plans import fixtures as fx

    names = ["spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"]
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")  # not what divides the product
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ent = fx.entities_skewed(fx.read_table(spark, "/root/testdata/sf0.1", "embeddings").repartition(8))
        pairs = _pair_frame(ent, None).groupBy(F.spark_partition_id().alias("task")).count().collect()
        hot = _pair_frame(ent, None).where("prd_id = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
        plain = {r.prd_id: r.asDict() for r in similarity.similarity_inner(ent, hot_key_rows=1 << 40)[0].collect()}
        split = {r.prd_id: r.asDict() for r in similarity.similarity_inner(ent)[0].collect()}
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = sorted(r["count"] for r in hot)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    every = sorted(r["count"] for r in pairs)
    assert every[-1] <= 2 * every[len(every) // 2]
    assert split == plain and "hot" in split


def test_null_and_equal_ids_give_the_same_scores_with_any_salting(spark):
    rows = [
        (None, "a", "product_name", [0.0, 1.0]),  # no id: a reject, never the first vector
        (4, "a", "product_name", [1.0, 0.0]),
        (4, "a", "product_name", [0.5, 1.0]),  # equal id: the least vector is the first
        (5, "a", "product_text", [1.0, 1.0]),
        (6, "a", "product_image", [0.0, 1.0]),
        (7, None, "product_name", [1.0, 0.0]),
        (8, None, "product_text", [1.0, 0.0]),
        (9, None, "product_image", [1.0, 0.0]),
        (10, "z", "product_name", [0.0, 0.0]),
        (11, "z", "product_text", [1.0, 0.0]),
        (12, "z", "product_image", [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "id long, prd_id string, prd_tag string, embedding array<float>")
    results = []
    for hot in (None, 1, 3, 200_000):
        scores, rejects = similarity.similarity_inner(df, hot_key_rows=hot)
        results.append((_scores(scores), sorted((r.prd_id or "", r.rule, r.column_name) for r in rejects.collect())))
    assert all(r == results[0] for r in results)
    scores, rejects = results[0]
    assert set(scores) == {"a"} and scores["a"][0] == pytest.approx(1.5 / (1.25**0.5 * 2**0.5))
    assert rejects == [("", "null_key", "prd_id")] * 3 + [("a", "null_key", "id"), ("z", "zero_vector", "embedding")]
