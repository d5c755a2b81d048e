"""G3/P18/F4/K8 trait rows and reply routing; J1 (long form), P9-P13, A2/A3, B1."""

import pytest

from traitlens.operators import entities, integrate, traits


def _replies(spark, rows):
    return spark.createDataFrame(rows, "prd_id string, status boolean, content string, error string")


def test_extract_traits_rows_and_rejects(spark):
    replies = _replies(
        spark,
        [
            ("a", True, 'ok [{"category1":"셔츠","color":"흰색"},{"category1":"바지","extra":1}]', None),
            ("b", True, "nothing useful", None),
            ("c", False, None, "timeout"),
            ("d", True, '{"material":"' + "x" * 51 + '"}', None),
            ("e", True, "{}", None),
        ],
    )
    valid, rejects = traits.extract_traits(replies, "text")
    got = sorted((r.prd_id, r.category1, r.color) for r in valid.collect())
    assert got == [("a", "바지", None), ("a", "셔츠", "흰색"), ("e", None, None)]
    assert valid.columns == ["category1", "category2", "color", "style", "material", "occasion", "prd_id"]
    rej = sorted((r.stage, r.prd_id, r.rule, r.column_name) for r in rejects.collect())
    assert rej == [("traits_text", "c", "model_error", None), ("traits_text", "d", "max_len", "material")]


def _trait_rows(spark, rows):
    return spark.createDataFrame(
        rows, "category1 string, category2 string, color string, style string, material string, occasion string, prd_id string"
    )


def test_integrate_long_form_counts_and_pairs(spark):
    raw = spark.createDataFrame(
        [("p1", "셔츠", "name one"), ("p2", "바지", "name two"), ("p3", None, "no category"), ("p4", "x", "no traits")],
        "prd_id string, category string, prd_name string",
    )
    text = _trait_rows(
        spark,
        [("a", "b", "c", "d", "e", "f", "p1"), ("a2", None, None, "unknown", None, "g", "p1"), ("t", None, None, None, None, None, "p2"), ("z", None, None, None, None, None, "p3")],
    )
    image = _trait_rows(
        spark,
        [("i", "j", None, "k", None, "unknown", "p1"), ("i2", None, None, None, None, None, "p1"), ("i3", None, None, None, None, None, "p1"), ("q", None, None, None, None, None, "p3")],
    )
    valid, rejects = integrate.integrate_traits(raw, text, image)
    rows = valid.collect()
    # p1: 2 text + 3 image rows (the wide form would have 6 pair rows); p2 lacks image rows
    assert sorted((r.prd_id, r.trait_side) for r in rows) == [("p1", "image")] * 3 + [("p1", "text")] * 2
    pc = integrate.pair_counts(valid).first()
    assert (pc.n_text, pc.n_image, pc.n_pairs) == (2, 3, 6)
    # p3 has both sides but a null category: NOT NULL rule -> rejects, one per trait row
    assert sorted((r.prd_id, r.rule, r.column_name) for r in rejects.collect()) == [("p3", "not_null", "category")] * 2


def test_masked_concat_matches_concat_ws_semantics(spark):
    df = spark.createDataFrame(
        [("a", "", None, "d"), ("unknown", "unknown", "unknown", "unknown"), (None, None, None, None)],
        "category1 string, category2 string, style string, occasion string",
    )
    got = [r.t for r in df.select(entities.trait_document().alias("t")).collect()]
    assert got == ["a  d", "   ", ""]


def test_entity_documents_dedupe_and_prompt(spark):
    info = spark.createDataFrame(
        [
            ("p1", "c", "이름", "text", "a", "b", None, "s", None, "o"),
            ("p1", "c", "이름", "text", "a", "b", "other color", "s", None, "o"),
            ("p1", "c", "이름", "image", "x", "unknown", None, None, None, None),
        ],
        "prd_id string, category string, prd_name string, trait_side string, category1 string, category2 string, "
        "color string, style string, material string, occasion string",
    )
    docs = {(r.prd_tag, r.prd_text): r.prompt for r in entities.entity_documents(info, "inst").collect()}
    assert set(docs) == {("product_name", "이름"), ("product_text", "a b s o"), ("product_image", "x ")}
    assert docs[("product_name", "이름")] == "Instruct: inst\nQuery: 이름"


def test_to_entities_ids_norms_and_dimension_rule(spark):
    enc = spark.createDataFrame(
        [("p", "product_name", "n", [3.0, 4.0]), ("p", "product_text", "t", [1.0]), ("p", "product_image", "i", None)],
        "prd_id string, prd_tag string, prd_text string, embedding array<float>",
    )
    valid, rejects = entities.to_entities(enc, dim=2)
    v = valid.collect()
    assert len(v) == 1 and v[0].norm == pytest.approx(5.0)
    again = entities.to_entities(enc, dim=2)[0].first()
    assert again.id == v[0].id  # deterministic id
    assert sorted((r.rule, r.column_name) for r in rejects.collect()) == [("dim", "embedding"), ("not_null", "embedding")]


def test_integrate_salted_equals_plain(spark):
    raw = spark.createDataFrame([(f"p{i}", "c", f"n{i}") for i in range(5)], "prd_id string, category string, prd_name string")
    text = _trait_rows(spark, [(f"t{j}", None, None, None, None, None, "p0") for j in range(40)] + [("a", None, None, None, None, None, "p1")])
    image = _trait_rows(spark, [(f"i{j}", None, None, None, None, None, "p0") for j in range(30)] + [("b", None, None, None, None, None, "p1")])
    plain = sorted(tuple(r) for r in integrate.integrate_traits(raw, text, image)[0].collect())
    salted = sorted(tuple(r) for r in integrate.integrate_traits(raw, text, image)[0].collect())
    assert plain == salted and len(plain) == 72
