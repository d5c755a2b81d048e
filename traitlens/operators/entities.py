"""Integrated traits -> tagged documents -> vector entities.

Three document kinds per product: its name, the masked concatenation of each
text-trait row and of each image-trait row.  Duplicates are removed per
(product, text); each document gets an encoder prompt.  After encoding, an
entity gets a deterministic id (a hash of tag, product and text, so a retried
task reproduces it), its vector norm, and the dimension/width checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_ENCODER_INSTRUCT,
    DOCUMENT_TRAIT_KEYS,
    ENCODER_PROMPT_FORMAT,
    TAG_IMAGE,
    TAG_NAME,
    TAG_TEXT,
    UNKNOWN,
)
from ..functions.vectors import norm
from ..schemas import embedding_rules
from .quality import validate


def masked_concat(cols: Sequence[str | Column], unknown: str = UNKNOWN) -> Column:
    """Space-join of the parts with ``unknown`` blanked.

    Null parts are skipped, blanked parts stay as empty strings (so doubled or
    edge spaces survive), matching SQL ``CONCAT_WS``.
    """
    parts = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        parts.append(F.when(col == F.lit(unknown), F.lit("")).otherwise(col))
    return F.concat_ws(" ", *parts)


def trait_document(keys: Sequence[str] = DOCUMENT_TRAIT_KEYS) -> Column:
    return masked_concat(list(keys))


def encoder_prompt(text: Column, instruct: str = DEFAULT_ENCODER_INSTRUCT) -> Column:
    return F.format_string(ENCODER_PROMPT_FORMAT, F.lit(instruct), text)


def entity_documents(integrated: DataFrame, instruct: str = DEFAULT_ENCODER_INSTRUCT) -> DataFrame:
    """``(prd_id, prd_tag, prd_text, prompt)``, one row per distinct document.

    One pass: every integrated row emits its product's name document and its
    own trait document, and a single ``distinct`` (combined map-side before
    the shuffle) removes the repeats.  The name is functionally dependent on
    the product key, so exactly one name document per product remains.
    """
    side_tag = F.when(F.col("trait_side") == "text", F.lit(TAG_TEXT)).otherwise(F.lit(TAG_IMAGE))
    doc = F.struct(F.lit("").alias("prd_tag"), F.lit("").alias("prd_text"))
    name_doc = doc.withField("prd_tag", F.lit(TAG_NAME)).withField("prd_text", F.col("prd_name"))
    trait_doc = doc.withField("prd_tag", side_tag).withField("prd_text", trait_document())
    docs = (
        integrated.select("prd_id", F.explode(F.array(name_doc, trait_doc)).alias("d"))
        .select("prd_id", "d.prd_tag", "d.prd_text")
        .distinct()
    )
    return docs.withColumn("prompt", encoder_prompt(F.col("prd_text"), instruct))


def entity_id(tag: Column, prd_id: Column, text: Column) -> Column:
    """60 bits of the MD5 digest of the three values: the same for the same entity in any engine and any retry."""
    digest = F.md5(F.concat_ws("\x1f", *(F.coalesce(c, F.lit("")) for c in (tag, prd_id, text))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def to_entities(encoded: DataFrame, dim: int, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Encoded documents (with ``embedding``) -> entity rows + rejects (V1-V3)."""
    ent = encoded.select(
        entity_id(F.col("prd_tag"), F.col("prd_id"), F.col("prd_text")).alias("id"),
        "prd_id",
        "prd_text",
        "prd_tag",
        F.col("embedding").cast("array<float>").alias("embedding"),
    ).withColumn("norm", norm("embedding"))
    return validate(ent, embedding_rules(dim), "embed", materialize=materialize)
