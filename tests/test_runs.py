"""K1, K3-K7: stages publish together or not at all, and later runs touch only new products."""

import glob
import json
import os

import pytest

from traitlens.constants import DEFAULT_CATEGORY_MAP
from traitlens.operators import requests
from traitlens.plans import stages
from traitlens.sources.tables import TableStore, Unpublished

LINK = next(iter(DEFAULT_CATEGORY_MAP))
HEAD = "web-scraper-order,category-link-0-href,name,price3,rating,ratingValue,image-src,image2-src\n"
TABLES = ["product_raw", "requests_text", "requests_image", "replies_text", "replies_image", "products_trait_text", "products_trait_image",
          "products_trait_information", "product_embedding", "products_similarity_score_inner"]


def client_factory(folder, refuse=()):
    def factory():
        def client(request):
            parts = json.loads(request)["messages"][-1]["content"]
            asked = parts[0]["text"] if len(parts) == 1 else parts[1]["image_url"]["url"][-20:]
            with open(os.path.join(folder, f"{abs(hash(asked))}-{len(os.listdir(folder))}"), "w") as fh:
                fh.write(asked)
            if any(r in asked for r in refuse):
                raise RuntimeError("refused")
            return json.dumps([{"category1": asked[-9:-3], "style": "s", "occasion": "daily"}])

        return client

    return factory


@pytest.fixture()
def place(tmpdir_path):
    for d in ("images/prd_img", "calls"):
        os.makedirs(os.path.join(tmpdir_path, d))
    return tmpdir_path


def write_catalog(place, ids):
    path = os.path.join(place, f"catalog{len(ids)}.csv")
    with open(path, "w") as fh:
        fh.write(HEAD + "".join(f'"{i}","{LINK}","name {i % 15}\nof {i}","1,000원","(1)","4.5","u","v"\n' for i in ids))
    for i in ids:
        picture = os.path.join(place, "images/prd_img", f"{i}.jpg")
        if not os.path.exists(picture):
            with open(picture, "wb") as fh:
                fh.write(b"\xff\xd8" + str(i).encode() * 20)
    return path


def config(place, root, refuse=()):
    return stages.PipelineConfig(root=os.path.join(place, root), image_dir=os.path.join(place, "images"), chat=requests.ChatSettings(model="m"),
                                 chat_factory=client_factory(os.path.join(place, "calls"), refuse), dim=16)


def content(store):
    out = {t: sorted(map(repr, store.read(t).collect())) for t in TABLES}
    return out | {"rejects": sorted(map(repr, store.rejects().collect()))}


def test_a_second_run_with_new_products_equals_a_full_run_and_reads_no_old_reply(spark, place):
    first, every = list(range(20)), list(range(22))
    changed = stages.run(spark, config(place, "changed"), csv_path=write_catalog(place, first))
    sent = len(os.listdir(os.path.join(place, "calls")))
    assert sent == 40
    before = {t: changed.entries(t) for t in TABLES}
    # Replies of the first run become unreadable: the second must not open them.
    old = [f for t in ("replies_text", "replies_image") for e in before[t] for f in glob.glob(os.path.join(changed.path(e["path"]), "part-*"))]
    kept = {}
    for f in old:
        with open(f, "rb") as fh:
            kept[f] = fh.read()
        with open(f, "wb") as fh:
            fh.write(b"not parquet")
    spark.catalog.clearCache()
    path = write_catalog(place, every)
    stages.run(spark, config(place, "changed"), csv_path=path, changed_only=True)
    assert len(os.listdir(os.path.join(place, "calls"))) == sent + 4
    for f, data in kept.items():
        with open(f, "wb") as fh:
            fh.write(data)
    for t in TABLES[1:]:
        assert changed.entries(t)[: len(before[t])] == before[t] and [e["kind"] for e in changed.entries(t)[len(before[t]) :]] == ["delta"], t
    full = stages.run(spark, config(place, "full"), csv_path=path)
    got, expected = content(changed), content(full)
    for t in TABLES:
        # The two runs have folders of their own only for their own tables: rows are equal.
        assert got[t] == expected[t], t
    assert got["rejects"] == expected["rejects"]
    # Nothing new: nothing is written.
    last = changed._manifests()[-1]
    stages.run(spark, config(place, "changed"), stages=stages.STAGES[1:], changed_only=True)
    assert changed._manifests()[-1] == last


def test_failed_calls_are_asked_again_and_their_rows_replaced(spark, place):
    path = write_catalog(place, list(range(12)))
    store = stages.run(spark, config(place, "t", refuse=("of 3", "of 7")), csv_path=path)
    assert {r.prd_id for r in store.rejects().where("rule = 'model_error'").collect()} == {"3", "7"}
    assert store.read("products_similarity_score_inner").count() == 10
    stages.run(spark, config(place, "t"), stages=stages.STAGES[1:], changed_only=True)
    assert store.rejects().where("rule = 'model_error'").count() == 0
    assert store.read("products_similarity_score_inner").count() == 12
    assert store.read("replies_text").count() == 12 and store.read("replies_text").where("not status").count() == 0


def test_a_stage_that_fails_between_its_writes_publishes_nothing(spark, place, monkeypatch):
    path = write_catalog(place, list(range(5)))
    store = stages.run(spark, config(place, "t"), csv_path=path)
    before, manifest = content(store), store._manifests()[-1]
    write = TableStore.write_rejects

    def dies(self, rejects, stage, kind=None):
        if stage in ("image_requests", "embed"):
            raise RuntimeError("the driver is lost here")
        write(self, rejects, stage, kind)

    monkeypatch.setattr(TableStore, "write_rejects", dies)
    other = write_catalog(place, list(range(9)))
    with pytest.raises(RuntimeError):
        stages.run(spark, config(place, "t"), stages=("trait_requests",))
    with pytest.raises(RuntimeError):
        stages.run(spark, config(place, "t"), stages=("embed",))
    assert content(store) == before and store._manifests()[-1] == manifest
    monkeypatch.undo()
    stages.run(spark, config(place, "t"), csv_path=other, changed_only=True)
    assert store.read("products_similarity_score_inner").count() == 9


def test_declared_types_and_not_null_are_checked(spark, place):
    store = TableStore(spark, os.path.join(place, "t"))
    store.create_all()
    store.create_all()
    assert len(store._manifests()) == 1
    scores = "prd_id string, similarity_name_text double, similarity_name_image double, similarity_text_image double"
    with pytest.raises(Unpublished):
        store.write(spark.createDataFrame([("1", 0.5, None, 0.5)], scores), "products_similarity_score_inner")
    assert store.read("products_similarity_score_inner").count() == 0
    store.write(spark.createDataFrame([("1", 0.5)], "prd_id string, similarity double").selectExpr("*", "1.0D as similarity_name_text", "1.0D as similarity_name_image", "1.0D as similarity_text_image"), "products_similarity_score_inner")
    with pytest.raises(ValueError):
        store.read("products_similarity_score_inner")


def test_two_runs_do_not_publish_the_same_manifest(spark, place):
    store, other = (TableStore(spark, os.path.join(place, "t")) for _ in range(2))
    rows = spark.createDataFrame([("1",)], "prd_id string")
    with pytest.raises(Unpublished):
        with store.publish("one"):
            store.write(rows, "x")
            other.write(rows, "x")
    assert other.read("x").count() == 1 and len(other._manifests()) == 1
