"""Corpus pipeline: quality rules, near-dedup, decontamination, pseudonyms, and SentencePiece ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.  Rows keep their order of decisions: what a stage
drops is not seen by the next.

Verdicts are found and joined back by a key of the text (63 bits of its SHA-256), not by doc_id, so rows without doc_id and
rows that share one are judged like all others.  Unlike texts that met in one key would share a verdict (about 5 of 10
billion texts).

Defined results: a text that is null, empty or without words is dropped by the first stage; of the rows of a group of
near-duplicates the one with the least doc_id stays (ties: least text key; rows without doc_id come last); unlike texts
with one doc_id all stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlens.llm import decontaminate, neardup, pieces, pseudonyms, quality
from traitlens.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.passing(docs)


def _key() -> Column:
    """A text's key; texts are not null after the first stage."""
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long").bitwiseAND(F.lit((1 << 63) - 1))


def _with_key(docs: DataFrame) -> DataFrame:
    """The rows as one column each, with their text keys."""
    return docs.select(_key().alias("text_key"), F.struct(*docs.columns).alias("row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id."""
    texts = docs.select(_key().alias("doc_id"), "text")
    groups = neardup.near_duplicates(texts).select(F.col("doc_id").alias("text_key"), F.col("component_id").alias("comp")).distinct()
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("id"), "text_key")
    # Equal texts first, then equal groups: a large group of copies is added up before it is dealt.
    least = docs.select("doc_id", _key().alias("text_key")).groupBy("text_key").agg(F.min(order).alias("first"))
    kept = cut_lineage(least.join(groups, "text_key").groupBy("comp").agg(F.min("first").alias("first")), "kept")
    keys = kept.select("first.text_key", F.col("first.id").alias("id"))
    found = _with_key(docs).join(keys, "text_key").where(F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")))
    return found.dropDuplicates(["text_key"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating overlap with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    texts = docs.select(_key().alias("doc_id"), "text")
    bad = decontaminate.verdicts(texts, benchmark).where("contaminated").select(F.col("doc_id").alias("text_key")).distinct()
    return _with_key(docs).join(bad, "text_key", "left_anti").select("row.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with validated personal values replaced under the session's key; n_chars follows the text."""
    out = pseudonyms.with_pseudonyms(docs, pseudonyms.session_key(spark))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece_ids),
]

# Compression ratios, keyed permutations and token ids have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, name)
    return docs
