"""Steps that grew faster than their input: picture files, requests without their picture, replies parsed twice."""

from __future__ import annotations

import os

from traitlens.operators import inference
from traitlens.plans import fixtures as fx
from traitlens.plans import queries
from traitlens.sources.images import save_factory

SF = "/root/testdata/sf0.001"


def test_a_folder_is_made_once(tmp_path):
    save = save_factory()
    save(f"{tmp_path}/a/b/1.jpg", b"1")
    made = os.stat(tmp_path / "a" / "b").st_ctime_ns
    save(f"{tmp_path}/a/b/1.jpg", b"2")
    assert (tmp_path / "a" / "b" / "1.jpg").read_bytes() == b"2" and os.stat(tmp_path / "a" / "b").st_ctime_ns == made


def test_picture_files_are_spread_over_folders(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(300)] + [(None, "x"), (1, None)], "doc_id long, text string")
    folder = fx.write_pictures(docs)
    paths = {r.prd_id: r.prd_img for r in fx.picture_products(docs, folder).collect()}
    assert paths[None] is None and len({os.path.dirname(p) for p in paths.values() if p}) > 100
    for i in range(300):
        size = i % 7
        assert os.path.exists(paths[str(i)]) == (size % 3 != 0)
        if size % 3:
            assert os.path.getsize(paths[str(i)]) == size


def test_small_requests_are_dealt_over_tasks(spark):
    reqs = spark.createDataFrame([(str(i), "{}") for i in range(100)], "prd_id string, request string").coalesce(1)
    bound = inference.bound_requests(reqs, tasks=5)
    assert bound.rdd.getNumPartitions() == 5 and bound.count() == 100


def test_replies_that_are_read_twice_are_parsed_once(spark):
    once, plain = queries._integrated(spark, SF, both=True), queries._integrated(spark, SF)
    assert "Generate" not in once._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plain._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))
