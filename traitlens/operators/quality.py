"""Declared constraints as one data-driven check: ``validate(df, rules)``.

A violation never fails the job: the offending row goes to a rejects frame
``(stage, prd_id, rule, column_name, detail)`` (one row per violated rule) and
the remaining rows continue.  Both outputs derive from one tagged projection;
callers that consume both should write or checkpoint the tagged frame once
(see ``plans/stages.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Rule
from ..session import cut_lineage

VIOLATIONS = "_violations"


def _violation(rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "max_len":
        cond = F.length(c) > F.lit(rule.arg)
        detail = F.format_string(f"length %d > {rule.arg}", F.length(c))
    elif rule.kind == "not_null":
        cond = c.isNull()
        detail = F.lit("null")
    elif rule.kind == "dim":
        cond = F.size(c) != F.lit(rule.arg)
        detail = F.format_string(f"dim %d != {rule.arg}", F.size(c))
    else:
        raise ValueError(f"unknown rule kind {rule.kind!r}")
    payload = F.struct(
        F.lit(rule.kind).alias("rule"), F.lit(rule.column).alias("column_name"), detail.alias("detail")
    )
    return F.when(F.coalesce(cond, F.lit(False)), payload)


def tag_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_violations``: array of (rule, column_name, detail), empty when the row is valid."""
    checks = [_violation(r) for r in rules]
    if not checks:
        return df.withColumn(VIOLATIONS, F.array().cast("array<struct<rule:string,column_name:string,detail:string>>"))
    return df.withColumn(VIOLATIONS, F.filter(F.array(*checks), lambda v: v.isNotNull()))


def split_tagged(tagged: DataFrame, stage: str, id_col: str = "prd_id") -> tuple[DataFrame, DataFrame]:
    valid = tagged.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    rejects = tagged.where(F.size(VIOLATIONS) > 0).select(
        F.lit(stage).alias("stage"),
        F.col(id_col).cast("string").alias("prd_id"),
        F.explode(VIOLATIONS).alias("v"),
    ).select("stage", "prd_id", "v.rule", "v.column_name", "v.detail")
    return valid, rejects


def validate(
    df: DataFrame, rules: Sequence[Rule], stage: str, id_col: str = "prd_id", materialize: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows meeting every rule and one reject row per violation.

    With ``materialize`` the tagged frame is written once to the shared
    staging folder, so writing both outputs does not compute ``df`` twice.
    """
    tagged = tag_violations(df, rules)
    if materialize:
        tagged = cut_lineage(tagged, stage)
    return split_tagged(tagged, stage, id_col)


def reject_frame(df: DataFrame, stage: str, rule: str, column: str | None, detail: Column) -> DataFrame:
    """Build rejects for rows already known to be bad (model errors, failed casts, ...)."""
    return df.select(
        F.lit(stage).alias("stage"),
        F.col("prd_id").cast("string").alias("prd_id"),
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column_name"),
        detail.cast("string").alias("detail"),
    )
