"""P14-P17, S5/J4: requests and images; U1-U4: model jobs with doubles."""

import base64
import json
import os

import numpy as np
import pytest

from traitlens.operators import inference, requests, traits
from traitlens.plans.doubles import echo_trait_client_factory
from traitlens.sources.images import read_images

SETTINGS = requests.ChatSettings(model="m", role_prompt="role", temperature=0.0)


def _raw(spark, rows):
    return spark.createDataFrame(rows, "prd_id string, prd_name string, prd_img string")


def test_text_request_shape(spark):
    raw = _raw(spark, [("1", 'a "quoted" name', "/x/1.jpg"), ("2", "no image", None)])
    reqs = requests.text_requests(raw, SETTINGS).collect()
    assert [r.prd_id for r in reqs] == ["1"]
    body = json.loads(reqs[0].request)
    assert body == {
        "model": "m",
        "temperature": 0.0,
        "messages": [
            {"role": "system", "content": [{"type": "text", "text": "role"}]},
            {"role": "user", "content": [{"type": "text", "text": 'What can you tell me about "a "quoted" name" ?'}]},
        ],
    }


def test_image_requests_base64_and_missing_file(spark, tmpdir_path):
    img_dir = os.path.join(tmpdir_path, "prd_img")
    os.makedirs(img_dir)
    payload = bytes(range(256)) * 3  # > 57 bytes: Spark's MIME base64 would wrap lines
    with open(os.path.join(img_dir, "1.jpg"), "wb") as fh:
        fh.write(payload)
    raw = _raw(spark, [("1", "n1", f"{img_dir}/1.jpg"), ("2", "n2", f"{img_dir}/2.jpg")])
    present, missing = requests.attach_images(raw, read_images(spark, tmpdir_path))
    reqs = requests.image_requests(present, SETTINGS).collect()
    assert [r.prd_id for r in reqs] == ["1"]
    url = json.loads(reqs[0].request)["messages"][1]["content"][1]["image_url"]["url"]
    assert url == "data:image/jpeg;base64," + base64.b64encode(payload).decode("utf-8")
    assert json.loads(reqs[0].request)["messages"][1]["content"][0] == {
        "type": "text",
        "text": "What can you tell me about this image?",
    }
    assert [(r.prd_id, r.rule) for r in missing.collect()] == [("2", "missing_image")]


def test_chat_job_captures_errors_per_row(spark):
    raw = _raw(spark, [("1", "hot gear", "/p"), ("2", "small ring", "/p"), ("3", "red widget", "/p")])
    reqs = requests.text_requests(raw, SETTINGS)
    replies = inference.run_chat_job(reqs, echo_trait_client_factory, max_in_flight=2, tasks=2)
    got = {r.prd_id: r for r in replies.collect()}
    assert got["1"].status is False and "refused" in got["1"].error
    assert got["2"].status is True
    valid, rejects = traits.extract_traits(replies, "text")
    assert sorted((r.prd_id, r.category1, r.color, r.style) for r in valid.collect()) == [
        ("2", "ring", "small", "small ring"),
        ("3", "widget", "red", "red widget"),
    ]
    assert [r.prd_id for r in rejects.collect()] == ["1"]


def test_encoder_job_batches_and_isolates_failures(spark):
    def factory():
        def enc(texts):
            if any("bad" in t for t in texts):
                raise ValueError("cannot encode")
            return np.array([[len(t), 1.0] for t in texts])

        return enc

    docs = spark.createDataFrame([("a", "abc"), ("b", "bad"), ("c", "de")], "prd_id string, prompt string")
    out = {r.prd_id: r.embedding for r in inference.encode_documents(docs, factory).collect()}
    assert out["a"] == [3.0, 1.0] and out["c"] == [2.0, 1.0] and out["b"] is None


def test_encoder_sees_bounded_batches(spark):
    def factory():
        def enc(texts):
            assert len(texts) <= 7
            return np.array([[float(len(texts))] for _ in texts])

        return enc

    docs = spark.range(50).selectExpr("cast(id as string) as prd_id", "cast(id as string) as prompt").coalesce(1)
    sizes = [r.embedding[0] for r in inference.encode_documents(docs, factory, batch_size=7).collect()]
    assert len(sizes) == 50 and max(sizes) == 7.0


def test_hashing_encoder_unit_vectors(spark):
    docs = spark.createDataFrame([("a", "red shirt"), ("b", "Red  SHIRT"), ("c", "")], "prd_id string, prd_text string")
    out = {r.prd_id: np.array(r.embedding) for r in inference.hashing_encode(docs, 32).collect()}
    assert out["a"].shape == (32,)
    assert np.linalg.norm(out["a"]) == pytest.approx(1.0, abs=1e-6)
    assert np.allclose(out["a"], out["b"])
    assert not out["c"].any()


def test_shared_image_path_is_exact(spark, tmpdir_path):
    img_dir = os.path.join(tmpdir_path, "prd_img")
    os.makedirs(img_dir)
    with open(os.path.join(img_dir, "shared.jpg"), "wb") as fh:
        fh.write(b"\xff\xd8shared")
    rows = [(str(i), f"n{i}", f"{img_dir}/shared.jpg") for i in range(60)] + [("x", "nx", f"{img_dir}/none.jpg")]
    raw = _raw(spark, rows)
    present, missing = requests.attach_images(raw, read_images(spark, tmpdir_path))
    assert sorted(r.prd_id for r in present.collect()) == sorted(str(i) for i in range(60))
    assert [r.prd_id for r in missing.collect()] == ["x"]


def test_chat_job_retries_transient_errors(spark):
    def make_factory():
        def factory():
            calls = {}

            def client(req):
                calls[req] = calls.get(req, 0) + 1
                if calls[req] < 2:  # every request fails once, then succeeds
                    raise TimeoutError("transient")
                return '{"category1": "ok"}'

            return client

        return factory

    raw = _raw(spark, [("1", "a b", "/p"), ("2", "c d", "/p")])
    reqs = requests.text_requests(raw, SETTINGS).coalesce(1)
    without = inference.run_chat_job(reqs, make_factory()).collect()
    assert all(r.status is False and "transient" in r.error for r in without)
    with_retry = inference.run_chat_job(reqs, make_factory(), retries=2, backoff_seconds=0.01).collect()
    assert all(r.status is True for r in with_retry)


def test_image_paths_with_a_scheme_are_found_and_missing_ones_read_no_bytes(spark, tmpdir_path):
    img_dir = os.path.join(tmpdir_path, "prd_img")
    os.makedirs(img_dir)
    with open(os.path.join(img_dir, "1.jpg"), "wb") as fh:
        fh.write(b"\xff\xd8one")
    raw = _raw(spark, [("1", "a", f"file://{img_dir}/1.jpg"), ("2", "b", f"file:{img_dir}/2.jpg")])
    present, missing = requests.attach_images(raw, read_images(spark, tmpdir_path))
    assert [r.prd_id for r in present.collect()] == ["1"]
    assert [r.prd_id for r in missing.collect()] == ["2"]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan and "content" not in plan.split("ReadSchema")[-1]


def test_products_without_a_name_are_not_asked_about(spark):
    raw = _raw(spark, [("1", "a b", "/p"), ("2", None, "/p"), ("3", "c", None)])
    assert [r.prd_id for r in requests.text_requests(raw, SETTINGS).collect()] == ["1"]
    assert [(r.prd_id, r.column_name) for r in requests.unnamed_rejects(raw).collect()] == [("2", "prd_name")]
