"""Model replies -> trait rows.

A reply row is ``(prd_id, status, content, error)``.  Successful replies are
parsed with the JSON-object contract of ``functions.jsonx`` and produce one
trait row per valid object (none for an empty list); failed replies become
rejects.  Parsing, explode and width checks all stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TRAIT_KEYS
from ..functions.jsonx import count_json_objects, extract_json_objects
from ..schemas import RULES
from .quality import reject_frame, validate


def split_replies(replies: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Route successful replies on, failed ones (status false or null) to rejects."""
    ok = replies.where(F.col("status"))
    failed = replies.where(~F.coalesce(F.col("status"), F.lit(False)))
    return ok, reject_frame(failed, stage, "model_error", None, F.col("error"))


def trait_objects(replies_ok: DataFrame, keys=TRAIT_KEYS) -> DataFrame:
    """One row per valid JSON object in a reply: ``keys..., prd_id``."""
    objs = replies_ok.select(
        F.col("prd_id"), F.explode(extract_json_objects(F.col("content"), keys)).alias("t")
    )
    return objs.select(*[F.col("t")[k].alias(k) for k in keys], F.col("prd_id"))


def object_counts(replies: DataFrame) -> DataFrame:
    """Per reply, how many valid objects its content holds (the array helper on its own)."""
    return replies.select("prd_id", count_json_objects(F.col("content")).alias("n_objects"))


def extract_traits(replies: DataFrame, side: str, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Replies of one side (``text`` or ``image``) -> valid trait rows and rejects.

    Rejects: failed model calls, and trait rows breaking the declared widths
    or a null product id.
    """
    stage = f"traits_{side}"
    ok, failed = split_replies(replies, stage)
    rows = trait_objects(ok)
    valid, bad = validate(rows, RULES[f"products_trait_{side}"], stage, materialize=materialize)
    return valid, failed.unionByName(bad)
