"""Property tests: generated inputs checked against plain statements of the semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st

from traitlens.operators import entities

TRAIT = st.one_of(st.none(), st.just("unknown"), st.just(""), st.just("Unknown"), st.text(alphabet="ab 셔츠", max_size=4))
ROWS = st.lists(st.tuples(TRAIT, TRAIT, TRAIT, TRAIT), min_size=1, max_size=40)


def concat_ws_statement(parts):
    """CONCAT_WS(' ', CASE WHEN p = 'unknown' THEN '' ELSE p END, ...): nulls skipped, blanks kept."""
    return " ".join("" if p == "unknown" else p for p in parts if p is not None)


@settings(max_examples=8, deadline=None)
@given(ROWS)
def test_masked_concat_property(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, category1 string, category2 string, style string, occasion string"
    )
    got = {r.i: r.t for r in df.select("i", entities.trait_document().alias("t")).collect()}
    assert got == {i: concat_ws_statement(r) for i, r in enumerate(rows)}
