"""Table schemas and the constraints declared on them, kept as data.

Widths are checked in characters (``length``), not bytes; a DataFrame
``varchar(n)`` is deliberately not used because Spark only enforces it on
table insert, where a violation fails the whole job instead of one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .constants import TRAIT_KEYS

S = T.StringType()

# NUMERIC without precision has no exact Spark equivalent; a fixed decimal wide
# enough for prices and review counts is used.
CATALOG_DECIMAL = T.DecimalType(20, 4)

PRODUCT_RAW = T.StructType(
    [
        T.StructField("prd_id", S, False),
        T.StructField("category", S),
        T.StructField("prd_name", S),
        T.StructField("price", CATALOG_DECIMAL),
        T.StructField("review", CATALOG_DECIMAL),
        T.StructField("review_rating", CATALOG_DECIMAL),
        T.StructField("prd_img", S),
    ]
)

TRAIT_ROW = T.StructType(
    [T.StructField(k, S) for k in TRAIT_KEYS] + [T.StructField("prd_id", S, False)]
)

# Integrated traits, long form: one row per trait row of either side, for
# products present in the catalog with at least one row on each side.
TRAIT_INFORMATION = T.StructType(
    [
        T.StructField("prd_id", S, False),
        T.StructField("category", S, False),
        T.StructField("prd_name", S, False),
        T.StructField("trait_side", S, False),
    ]
    + [T.StructField(k, S) for k in TRAIT_KEYS]
)

REPLIES = T.StructType(
    [
        T.StructField("prd_id", S, False),
        T.StructField("status", T.BooleanType(), False),
        T.StructField("content", S),
        T.StructField("error", S),
    ]
)

ENTITY = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("prd_id", S, False),
        T.StructField("prd_text", S, False),
        T.StructField("prd_tag", S, False),
        T.StructField("embedding", T.ArrayType(T.FloatType(), False), False),
        T.StructField("norm", T.DoubleType()),
    ]
)

SIMILARITY_SCORE = T.StructType(
    [
        T.StructField("prd_id", S, False),
        T.StructField("similarity_name_text", T.DoubleType(), False),
        T.StructField("similarity_name_image", T.DoubleType(), False),
        T.StructField("similarity_text_image", T.DoubleType(), False),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("stage", S, False),
        T.StructField("prd_id", S),
        T.StructField("rule", S, False),
        T.StructField("column_name", S),
        T.StructField("detail", S),
    ]
)


@dataclass(frozen=True)
class Rule:
    """One declared constraint: ``max_len`` (n characters), ``not_null`` or ``dim`` (array size)."""

    column: str
    kind: str
    arg: int | None = None


def _widths(pairs):
    return [Rule(c, "max_len", n) for c, n in pairs]


_TRAIT_WIDTHS = [
    ("category1", 30),
    ("category2", 30),
    ("color", 50),
    ("style", 50),
    ("material", 50),
    ("occasion", 50),
]

RULES = {
    "product_raw": [Rule("prd_id", "not_null")]
    + _widths([("prd_id", 30), ("category", 20)]),
    "products_trait_text": [Rule("prd_id", "not_null")]
    + _widths(_TRAIT_WIDTHS + [("prd_id", 30)]),
    "products_trait_image": [Rule("prd_id", "not_null")]
    + _widths(_TRAIT_WIDTHS + [("prd_id", 30)]),
    "products_trait_information": [
        Rule("prd_id", "not_null"),
        Rule("category", "not_null"),
        Rule("prd_name", "not_null"),
    ]
    + _widths([("prd_id", 30), ("category", 20)] + _TRAIT_WIDTHS),
    "product_embedding": [
        Rule("prd_id", "not_null"),
        Rule("prd_text", "not_null"),
        Rule("prd_tag", "not_null"),
    ]
    + _widths([("prd_id", 50), ("prd_text", 500), ("prd_tag", 50)]),
    "products_similarity_score_inner": [
        Rule(c, "not_null")
        for c in (
            "prd_id",
            "similarity_name_text",
            "similarity_name_image",
            "similarity_text_image",
        )
    ]
    + _widths([("prd_id", 30)]),
}


def embedding_rules(dim: int) -> list[Rule]:
    return RULES["product_embedding"] + [Rule("embedding", "not_null"), Rule("embedding", "dim", dim)]


# DDL for managed tables (idempotent creation).
TABLE_SCHEMAS = {
    "product_raw": PRODUCT_RAW,
    "products_trait_text": TRAIT_ROW,
    "products_trait_image": TRAIT_ROW,
    "products_trait_information": TRAIT_INFORMATION,
    "product_embedding": ENTITY,
    "products_similarity_score_inner": SIMILARITY_SCORE,
}
