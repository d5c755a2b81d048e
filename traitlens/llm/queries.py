"""Registered queries of the dealt operators: whole tables in, the contracts' columns out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annindex, chat, decontaminate, divergence, hardneg, licenses, mixing, paragraphs, pieces, pseudonyms, quality, toxicity
from .neardup import near_duplicates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.paragraph_dedup(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), model_path or public_tokenizers.path("piece_bpe_32k.model"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonyms.session_key(spark))
    return found.withColumn("n_found", sum(F.col(f"n_{kind}") for kind in pseudonyms.KINDS))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_scan(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql(
        "SELECT -7L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM range(2)"
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.windows(conversations))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annindex.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_pii": op7_pii,
    "op8_license_scan": op8_license_scan,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_source_divergence": op11_source_divergence,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": decontaminate.VERDICTS_SQL,
    "op11_source_divergence": divergence.AUDIT_SQL,
    "op12_hard_negatives": hardneg.MINE_SQL,
}
