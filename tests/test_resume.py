"""U1-U3: calls are kept by content, published by chunk and never repeated once finished."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from traitlens.operators import inference, requests
from traitlens.operators.resume import DIGEST, digest
from traitlens.plans import fixtures as fx
from traitlens.plans import queries
from traitlens.plans.doubles import letter_encoder_factory

SETTINGS = requests.ChatSettings(model="m", role_prompt="role", temperature=0.0)
ROWS = "prd_id string, prd_name string, prd_img string"


def counting_factory(folder, die_after=None, fail_on=()):
    """Client double that notes every call in a file of its own; the process dies after so many calls in all."""

    def factory():
        lock = threading.Lock()

        def client(request_json):
            question = json.loads(request_json)["messages"][-1]["content"][0]["text"]
            with lock:
                done = len(os.listdir(folder))
                if die_after is not None and done >= die_after:
                    os._exit(1)  # the worker is lost with everything it holds
                with open(os.path.join(folder, f"{done:06d}-{os.getpid()}-{abs(hash(question))}"), "w") as fh:
                    fh.write(question)
            if any(f in question for f in fail_on):
                raise RuntimeError("refused")
            return json.dumps({"category1": question[-10:]})

        return client

    return factory


def calls(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name)) as fh:
            out.append(fh.read())
    return out


@pytest.fixture()
def folders(tmpdir_path):
    made = [os.path.join(tmpdir_path, d) for d in ("calls", "log")]
    os.makedirs(made[0])
    return made


def asked(spark, n, names=None):
    rows = [(str(i), names[i % len(names)] if names else f"name {i}", "/p") for i in range(n)]
    return requests.text_requests(spark.createDataFrame(rows, ROWS), SETTINGS)


def test_a_job_that_dies_repeats_only_the_chunk_it_was_in(spark, folders):
    where, path = folders
    reqs = asked(spark, 60)
    log = inference.chat_log(spark, path)
    with pytest.raises(Exception):
        inference.resume_chat_job(reqs, log, counting_factory(where, die_after=35), tasks=1, chunk_rows=10)
    first = calls(where)
    kept = log.read().count()
    assert 0 < kept < 60
    got = inference.resume_chat_job(reqs, log, counting_factory(where), tasks=2, chunk_rows=10).collect()
    assert sorted(int(r.prd_id) for r in got) == list(range(60)) and all(r.status for r in got)
    every = calls(where)
    finished = len(first) - kept
    # What had been published is never sent again; only calls of the unfinished chunk are.
    assert len(set(every)) == 60 and len(every) - 60 <= max(finished, 0)
    again = inference.resume_chat_job(reqs, log, counting_factory(where), chunk_rows=10).collect()
    assert len(again) == 60 and len(calls(where)) == len(every)


def test_equal_requests_are_sent_once_and_new_ones_only_later(spark, folders):
    where, path = folders
    names = ["same"] * 8 + ["other", "third"]
    log = inference.chat_log(spark, path)
    got = inference.resume_chat_job(asked(spark, 400, names), log, counting_factory(where), chunk_rows=2).collect()
    assert len(got) == 400 and sorted(calls(where)) == sorted({requests.TEXT_QUESTION_PREFIX + n + requests.TEXT_QUESTION_SUFFIX for n in names})
    got = inference.resume_chat_job(asked(spark, 440, names + ["fourth"]), log, counting_factory(where)).collect()
    assert len(got) == 440 and len(calls(where)) == 4


def test_failed_calls_are_reported_and_tried_again_by_the_next_run(spark, folders):
    where, path = folders
    reqs, log = asked(spark, 6), inference.chat_log(spark, path)
    first = {r.prd_id: r for r in inference.resume_chat_job(reqs, log, counting_factory(where, fail_on=("name 3", "name 5"))).collect()}
    assert [p for p in sorted(first) if not first[p].status] == ["3", "5"] and "refused" in first["3"].error
    second = inference.resume_chat_job(reqs, log, counting_factory(where, fail_on=("name 5",))).collect()
    assert sorted((r.prd_id, r.status) for r in second) == [("0", True), ("1", True), ("2", True), ("3", True), ("4", True), ("5", False)]
    assert len(calls(where)) == 8


def test_pictures_are_bound_when_sent_and_asked_again_when_they_change(spark, tmpdir_path, folders):
    path = os.path.join(tmpdir_path, "1.jpg")
    raw = spark.createDataFrame([("1", "n", path), ("2", "n", f"file://{path}"), ("3", "n", path + ".none"), ("4", "n", None)], ROWS)
    log = inference.chat_log(spark, folders[1])

    def factory():
        return lambda request: json.loads(request)["messages"][1]["content"][1]["image_url"]["url"]

    seen = []
    for content in (b"\xff\xd8one", b"\xff\xd8another"):
        with open(path, "wb") as fh:
            fh.write(content)
        present, missing = requests.attach_pictures(raw)
        reqs = requests.image_requests(present, SETTINGS)
        assert all("base64" not in r.request and path in r.request for r in reqs.collect())
        assert [(r.prd_id, r.rule) for r in missing.collect()] == [("3", "missing_image")]
        got = {r.prd_id: r.content for r in inference.resume_chat_job(reqs, log, factory).collect()}
        assert sorted(got) == ["1", "2"] and len(set(got.values())) == 1
        seen.append(got["1"])
    assert seen[0] != seen[1] and all(u.startswith("data:image/jpeg;base64,") for u in seen)


def test_the_driver_lists_no_pictures(spark, tmpdir_path):
    reqs = requests.image_requests(requests.attach_pictures(spark.createDataFrame([("1", "n", "/none.jpg")], ROWS))[0], SETTINGS)
    plan = reqs._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "InMemoryFileIndex" not in plan.replace("InMemoryFileIndex(1 paths)", "")


def encoder_counter(folder):
    def factory():
        plain = letter_encoder_factory()

        def encode(texts):
            for t in texts:
                with open(os.path.join(folder, f"{len(os.listdir(folder)):06d}-{os.getpid()}-{abs(hash(t))}"), "w") as fh:
                    fh.write(t)
            return plain(texts)

        return encode

    return factory


def test_each_distinct_text_is_encoded_once(spark, folders):
    where, path = folders
    texts = ["hot text"] * 200 + ["b", "c", None, ""]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "prd_id string, prompt string")
    plain = inference.encode_documents(docs, encoder_counter(where)).collect()
    assert len(plain) == 204 and sorted(calls(where)) == ["", "b", "c", "hot text"]
    log = inference.vector_log(spark, path)
    kept = inference.encode_documents(docs, encoder_counter(where), log=log).collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, plain)) and len(calls(where)) == 8
    more = docs.unionByName(spark.createDataFrame([("x", "new")], docs.schema))
    assert inference.encode_documents(more, encoder_counter(where), log=log).count() == 205
    assert calls(where).count("new") == 1 and len(calls(where)) == 9
    inference.encode_documents(docs, encoder_counter(where), log=log, encoder_name="v2")
    assert len(calls(where)) == 13


def test_encode_entities_encodes_distinct_texts(spark, folders, monkeypatch):
    where, _ = folders
    monkeypatch.setattr(queries.doubles, "letter_encoder_factory", encoder_counter(where))
    docs = queries.q_entity_documents(spark, "/root/testdata/sf0.001")
    out = queries.q_encode_entities(spark, "/root/testdata/sf0.001")
    assert out.count() == docs.count()
    assert len(calls(where)) == docs.select(F.countDistinct("prd_text")).first()[0] < docs.count()


def test_digests_keep_parts_apart(spark):
    row = spark.range(1).select(digest(F.lit("ab"), F.lit("c")).alias("x"), digest(F.lit("a"), F.lit("bc")).alias("y"), digest(F.lit(None), F.lit("")).alias(DIGEST)).first()
    assert len({*row}) == 3 and all(len(v) == 64 for v in row)


def test_infer_image_traits_reads_every_picture_file(spark):
    docs = fx.read_table(spark, "/root/testdata/sf0.001", "documents")
    expected = docs.where("length(text) % 3 <> 0 and octet_length(text) % 13 <> 0").count()
    assert queries.q_infer_image_traits(spark, "/root/testdata/sf0.001").count() == expected
