"""Catalog + text traits + image traits -> integrated trait information.

The original integration joins each product's text rows with its image rows,
emitting every text x image pair; its only consumer then removes that fan-out
again with three DISTINCTs.  Materialising all pairs within a product is
quadratic in a product's trait rows, so this operator emits the same content
in long form instead: one row per trait row of either side (``trait_side`` =
``text`` / ``image``), for catalog products that have at least one row on
each side.  The pair count of the wide form per product is available from
``pair_counts`` without emitting the pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TRAIT_KEYS
from ..schemas import RULES
from .quality import validate

INFO_COLUMNS = ["prd_id", "category", "prd_name", "trait_side", *TRAIT_KEYS]


def products_with_both_sides(rows: DataFrame) -> DataFrame:
    """Products with rows of both ``trait_side``s (one aggregate, combined map-side)."""
    sides = rows.groupBy("prd_id").agg(*(F.max(F.when(F.col("trait_side") == s, True)).alias(s) for s in ("text", "image")))
    return sides.where("text and image").select("prd_id")


def integrate_traits(
    product_raw: DataFrame,
    text_traits: DataFrame,
    image_traits: DataFrame,
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(integrated rows, rejects).  Rejects: rows breaking NOT NULL / width rules
    (e.g. a product whose category link was not in the dictionary)."""
    rows = text_traits.withColumn("trait_side", F.lit("text")).unionByName(
        image_traits.withColumn("trait_side", F.lit("image"))
    )
    base = product_raw.select("prd_id", "category", "prd_name").join(products_with_both_sides(rows), "prd_id")
    joined = rows.join(base, "prd_id")  # a hot product's rows are divided by adaptive skew-join splitting
    return validate(
        joined.select(*INFO_COLUMNS), RULES["products_trait_information"], "integrate", materialize=materialize
    )


def pair_counts(integrated: DataFrame) -> DataFrame:
    """Per product: text rows, image rows and the wide form's row count (their product)."""
    counts = integrated.groupBy("prd_id").agg(
        F.count(F.when(F.col("trait_side") == "text", 1)).alias("n_text"),
        F.count(F.when(F.col("trait_side") == "image", 1)).alias("n_image"),
    )
    return counts.withColumn("n_pairs", F.col("n_text") * F.col("n_image"))
