"""The stage runner end to end on a tiny catalog (K1-K7 round trips), and the streaming parse."""

import json
import os

import pytest

from traitlens.constants import DEFAULT_CATEGORY_MAP
from traitlens.operators import requests, traits
from traitlens.plans import stages
from traitlens.sources.tables import TableStore
from traitlens.streaming.replies import stream_trait_extract

LINK = next(iter(DEFAULT_CATEGORY_MAP))
CSV = (
    "web-scraper-order,category-link-0-href,name,price3,rating,ratingValue,image-src,image2-src\n"
    f'"1","{LINK}","red shirt","12,300원","(12)","4.5","http://i/1.jpg",""\n'
    f'"2","{LINK}","blue pants","9,900원","(3)","4.0","http://i/2.jpg",""\n'
    f'"3","{LINK}","green hat","1,000원","","","http://i/3.jpg",""\n'
)


def make_client_factory():
    """Closure (pickled by value) returning a deterministic two-sided chat double."""

    def factory():
        return client

    def client(request_json):
        req = json.loads(request_json)
        parts = req["messages"][-1]["content"]
        if len(parts) > 1:  # image request
            return '[{"category1": "top", "category2": "unknown", "style": "casual", "occasion": "daily"}]'
        q = parts[0]["text"]
        name = q[q.index('"') + 1 : q.rindex('"')]
        return json.dumps([{"category1": name.split()[-1], "category2": name.split()[0], "style": "basic"}])

    return factory


@pytest.fixture()
def layout(tmpdir_path):
    csv = os.path.join(tmpdir_path, "catalog.csv")
    with open(csv, "w", encoding="utf-8") as fh:
        fh.write(CSV)
    img_dir = os.path.join(tmpdir_path, "images")
    os.makedirs(os.path.join(img_dir, "prd_img"))
    for pid in ("1", "2"):  # product 3 has no image file
        with open(os.path.join(img_dir, "prd_img", f"{pid}.jpg"), "wb") as fh:
            fh.write(b"\xff\xd8" + pid.encode() * 100)
    return csv, img_dir, os.path.join(tmpdir_path, "tables")


def test_pipeline_end_to_end(spark, layout):
    csv, img_dir, root = layout
    cfg = stages.PipelineConfig(
        root=root,
        image_dir=img_dir,
        chat=requests.ChatSettings(model="m"),
        chat_factory=make_client_factory(),
        dim=32,
    )
    store = stages.run(spark, cfg, csv_path=csv)
    assert store.read("product_raw").count() == 3
    assert store.read("requests_image").count() == 2
    rejects = store.rejects()
    assert [(r.stage, r.prd_id, r.rule) for r in rejects.where("stage = 'image_requests'").collect()] == [
        ("image_requests", "3", "missing_image")
    ]
    assert store.read("products_trait_text").count() == 3
    info = store.read("products_trait_information")
    assert sorted({r.prd_id for r in info.collect()}) == ["1", "2"]
    ent = store.read("product_embedding")
    assert sorted(r.prd_tag for r in ent.where("prd_id = '1'").collect()) == ["product_image", "product_name", "product_text"]
    scores = store.read("products_similarity_score_inner").collect()
    assert sorted(r.prd_id for r in scores) == ["1", "2"]
    assert all(-1.0 <= r.similarity_name_text <= 1.0 for r in scores)
    # stage 1 is insert-ignore: loading the same file again adds nothing
    stages.run(spark, cfg, stages=("catalog_load",), csv_path=csv)
    assert store.read("product_raw").count() == 3
    # later stages overwrite: re-running does not duplicate rows
    stages.run(spark, cfg, stages=("integrate", "embed", "score"))
    assert store.read("products_similarity_score_inner").count() == 2


def test_bucketed_entities_remove_scoring_exchanges(spark, layout):
    csv, img_dir, root = layout
    cfg = stages.PipelineConfig(
        root=root,
        image_dir=img_dir,
        chat=requests.ChatSettings(model="m"),
        chat_factory=make_client_factory(),
        dim=16,
        database="traitlens_test",
        entity_buckets=4,
    )
    store = stages.run(spark, cfg, csv_path=csv)
    from traitlens.operators.similarity import similarity_inner

    ent = store.read("product_embedding")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = similarity_inner(ent, hot_key_rows=1_000)[0]
        scores.collect()
        plan = scores._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Bucketed by product: the join and the first-vector aggregate need no exchange, and the branch of the hot products is
    # gone from the final plan; the only exchange left moves partial maxima, never vectors.
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) <= 1
    for i in exchanges:
        assert "partial_max" in lines[i + 1] and "embedding" not in lines[i + 1]
    assert store.read("products_similarity_score_inner").count() == 2


def test_streaming_parse_equals_batch(spark, tmpdir_path):
    rows = [
        (str(i), i % 4 != 0, f'x {{"category1": "c{i}", "color": "k"}} y' if i % 4 else None, None if i % 4 else "err")
        for i in range(40)
    ]
    replies = spark.createDataFrame(rows, "prd_id string, status boolean, content string, error string")
    src = os.path.join(tmpdir_path, "replies")
    replies.repartition(4).write.parquet(src)
    out, rej = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "rej")
    q = stream_trait_extract(spark, src, "text", out, rej, os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination(120)
    got = sorted((r.prd_id, r.category1) for r in spark.read.parquet(out).collect())
    valid, rejects = traits.extract_traits(replies, "text")
    assert got == sorted((r.prd_id, r.category1) for r in valid.collect())
    assert spark.read.parquet(rej).count() == rejects.count() == 10


def test_cli_runs_model_free_stages(spark, layout):
    from traitlens.__main__ import main

    csv, img_dir, root = layout
    main(["--root", root, "--image-dir", img_dir, "--csv", csv, "--stages", "catalog_load,trait_requests"])
    store = TableStore(spark, root)
    assert [store.read(t).count() for t in ("product_raw", "requests_text", "requests_image")] == [3, 3, 2]


def test_stage_report_counts_outputs_and_rejects(spark, layout):
    csv, img_dir, root = layout
    cfg = stages.PipelineConfig(root=root, image_dir=img_dir, chat=requests.ChatSettings(model="m"))
    stages.run(spark, cfg, stages=("catalog_load", "trait_requests"), csv_path=csv)
    report = stages.stage_report(TableStore(spark, root), "trait_requests")
    assert report == {"requests_text": 3, "requests_image": 2, "rejects[image_requests]": 1, "rejects[text_requests]": 0}


def test_stage_runner_removes_its_staging_data(spark, layout):
    import os as _os

    from traitlens.session import ensure_checkpoint_dir, staged_paths

    csv, img_dir, root = layout
    staging = _os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "traitlens-staging")

    def listing():
        return set(_os.listdir(staging)) if _os.path.isdir(staging) else set()

    before_paths, before_dirs = staged_paths(), listing()
    cfg = stages.PipelineConfig(root=root, image_dir=img_dir, chat=requests.ChatSettings(model="m"))
    stages.run(spark, cfg, stages=("catalog_load",), csv_path=csv)  # catalog_load stages its projection
    assert staged_paths() == before_paths
    assert listing() <= before_dirs
    assert TableStore(spark, root).read("product_raw").count() == 3


def test_streaming_restart_resumes_without_duplicates(spark, tmpdir_path):
    schema = "prd_id string, status boolean, content string, error string"
    src, out, rej, ckpt = (os.path.join(tmpdir_path, d) for d in ("replies", "out", "rej", "ckpt"))

    def add_file(start):
        rows = [(str(i), True, f'{{"category1": "c{i}"}}', None) for i in range(start, start + 10)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    add_file(0)
    stream_trait_extract(spark, src, "text", out, rej, ckpt).awaitTermination(120)
    add_file(10)  # new replies arrive; the restarted query must only parse these
    stream_trait_extract(spark, src, "text", out, rej, ckpt).awaitTermination(120)
    got = sorted(r.prd_id for r in spark.read.parquet(out).collect())
    assert got == sorted(str(i) for i in range(20))
    batches = sorted({r.batch_id for r in spark.read.parquet(out).select("batch_id").collect()})
    assert len(batches) == 2


def test_staging_needs_a_shared_folder_outside_local_mode(monkeypatch):
    from traitlens import session

    assert session._is_local("local") and session._is_local("local[4]")
    assert not session._is_local("local-cluster[2,1,1024]") and not session._is_local("yarn")

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Context:
        master = "yarn"
        folder = None

        def getConf(self):
            return Conf()

        def setCheckpointDir(self, path):
            self.folder = path

    class Session:
        conf, sparkContext = Conf(), Context()

    try:
        session.ensure_checkpoint_dir(Session())
        raise AssertionError("a cluster without a shared folder must be an error")
    except ValueError as error:
        assert "spark.checkpoint.dir" in str(error)
    assert session.ensure_checkpoint_dir(Session(), "s3a://bucket/_staging") == "s3a://bucket/_staging" == Context.folder or Session.sparkContext.folder
