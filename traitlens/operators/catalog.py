"""Scraped catalog -> ``product_raw`` rows.

Cleaning is a single projection: missing-value tokens to null, category by
dictionary, characters stripped from the review count and price, renamed
columns, derived image path, empty strings to null, and casts to decimal that
route non-castable values to rejects (the value becomes null, the row stays).
Insert-ignore keeps the first row per key in input order and skips keys the
target already holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CATALOG_RENAMES,
    CATEGORY_LINK_COLUMN,
    DEFAULT_CATEGORY_MAP,
    NA_TOKENS,
    PRICE_STRIP_CHARS,
    REVIEW_STRIP_CHARS,
)
from ..schemas import CATALOG_DECIMAL, PRODUCT_RAW, RULES
from ..session import cut_lineage
from .quality import VIOLATIONS, split_tagged, tag_violations

CATALOG_COLUMNS = [f.name for f in PRODUCT_RAW.fields]
NUMERIC_COLUMNS = ("price", "review", "review_rating")
ORDINAL = "_ord"


def na_to_null(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Token-for-token missing values (pandas' default list) -> null."""
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def category_lookup(link: Column, mapping: Mapping[str, str]) -> Column:
    """Exact link -> category name; unmapped links give null.

    The dictionary is a map literal evaluated inside the projection (no join);
    ``try_element_at`` keeps a missing key null under ANSI mode.
    """
    if not mapping:
        return F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), link)


def image_path(prd_id: Column, image_dir: str) -> Column:
    """``{image_dir}/prd_img/{prd_id}.jpg``; a null id gives a null path."""
    base = image_dir if image_dir.endswith("/") else image_dir + "/"
    return F.concat(F.lit(base), F.lit("prd_img/"), prd_id, F.lit(".jpg"))


def exact_decimal(text: Column) -> Column:
    """The number in the table's decimal type, or null when it is not one or would lose digits."""
    scale = CATALOG_DECIMAL.scale
    plain = ~text.rlike(rf"\.[0-9]{{{scale}}}[0-9]*[1-9]")
    # With an exponent: decimals of the digits, less the exponent and the zeros at their end.
    digits = F.regexp_replace(F.regexp_replace(text, "[eE].*$", ""), "[^0-9]", "")
    kept = F.regexp_replace(digits, "0+$", "")
    decimals = F.length(F.regexp_extract(text, r"\.([0-9]*)", 1))
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)", 1), F.lit("")).try_cast("long"), F.lit(0))
    shifted = (kept == "") | (decimals - exponent - (F.length(digits) - F.length(kept)) <= scale)
    return F.when(F.when(text.rlike("[eE]"), shifted).otherwise(plain), text.try_cast(CATALOG_DECIMAL))


def clean_catalog(
    raw: DataFrame,
    image_dir: str,
    category_map: Mapping[str, str] = DEFAULT_CATEGORY_MAP,
    na_tokens: Sequence[str] = NA_TOKENS,
    strip_thousands_in_review: bool = False,
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Raw scraped frame (original headers, all strings) -> (product rows, rejects).

    The ordinal column ``_ord``, when present, is carried through for
    ``insert_ignore``.
    """
    required = ["web-scraper-order", CATEGORY_LINK_COLUMN] + [_src(t) for t in ("prd_name", "price", "review", "review_rating")]
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"catalog input lacks the column(s) {missing}; found {raw.columns}")
    cols = {c: na_to_null(F.col(f"`{c}`"), na_tokens) for c in raw.columns if c != ORDINAL}
    review_chars = REVIEW_STRIP_CHARS + ("," if strip_thousands_in_review else "")
    out = {
        "prd_id": cols["web-scraper-order"],
        "category": category_lookup(cols[CATEGORY_LINK_COLUMN], category_map),
        "prd_name": cols[_src("prd_name")],
        "price_text": F.translate(cols[_src("price")], PRICE_STRIP_CHARS, ""),
        "review_text": F.translate(cols[_src("review")], review_chars, ""),
        "review_rating_text": cols[_src("review_rating")],
    }
    projected = raw.select(
        *[F.nullif(v, F.lit("")).alias(k) for k, v in out.items()],
        *([F.col(ORDINAL)] if ORDINAL in raw.columns else []),
    ).withColumn("prd_img", image_path(F.col("prd_id"), image_dir))
    projected = projected.withColumns({name: exact_decimal(F.col(f"{name}_text")) for name in NUMERIC_COLUMNS})
    keep = CATALOG_COLUMNS + ([ORDINAL] if ORDINAL in raw.columns else [])
    if materialize:  # both outputs below read the projection: compute it once
        projected = cut_lineage(projected, "catalog")
    # Failed casts and rule violations of a row in one array, split once.
    casts = [
        F.when(
            F.col(f"{name}_text").isNotNull() & F.col(name).isNull(),
            F.struct(F.lit("cast_decimal").alias("rule"), F.lit(name).alias("column_name"), F.col(f"{name}_text").alias("detail")),
        )
        for name in NUMERIC_COLUMNS
    ]
    tagged = tag_violations(projected, RULES["product_raw"])
    valid = tagged.where(F.size(VIOLATIONS) == 0).select(*keep)
    found = F.concat(F.filter(F.array(*casts), lambda v: v.isNotNull()), F.col(VIOLATIONS))
    rejects = split_tagged(tagged.withColumn(VIOLATIONS, found), "catalog")[1]
    return valid, rejects


def _src(target: str) -> str:
    for src, dst in CATALOG_RENAMES.items():
        if dst == target:
            return src
    raise KeyError(target)


def first_per_key(df: DataFrame, key: str = "prd_id", order_col: str = ORDINAL) -> DataFrame:
    """First row per key by ``order_col`` (input order); ties cannot occur for an ordinal.

    ``min_by`` is a decomposable aggregate: each map task keeps one row per key
    before the exchange, so a key repeated a billion times is combined map-side
    instead of landing whole in one task.
    """
    others = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_r"))
    return first.select(key, *[F.col("_r")[c].alias(c) for c in others])


def insert_ignore(new_rows: DataFrame, existing_keys: DataFrame, key: str = "prd_id", order_col: str = ORDINAL) -> DataFrame:
    """Rows to append: first row per new key, keys already in the target skipped.

    Existing rows are never updated.  Only the key column of the target is read.
    """
    first = first_per_key(new_rows, key, order_col)
    return first.join(existing_keys.select(key), key, "left_anti")
