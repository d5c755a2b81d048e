from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as components
from traitlens.llm import pseudonyms, quality

DIR = "/root/testdata/sf0.001"


def expected(rows, items):
    import zstandard

    from tests.llm.test_compression import brute as base

    codec = zstandard.ZstdCompressor(level=quality.LEVEL, write_checksum=False, write_content_size=False)
    rows = [(i, t) for i, t in rows if not base(t)[-1] and quality.compression(t.encode(), codec)[2]]
    kept = components(rows)
    rows = [(i, t) for i, t in rows if kept[i][2]]
    bad = {r[0] for r in contaminated(rows, items) if r[-1]}
    rows = [(i, pseudonyms.pseudonymise(t, "a key")[0]) for i, t in rows if i not in bad]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {i: model.encode(t) for i, t in rows}


def test_run_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    spark.conf.set(pseudonyms.KEY_CONF, "a key")
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got == expected(rows, items)
    assert 0 < len(got) < len(rows)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = docs.limit(30).withColumn("key", F.lit(1)).unionByName(docs.limit(2).selectExpr("cast(null as long) as doc_id", "text", "lang", "source", "n_chars", "1 as key"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, rows, DIR).columns == rows.columns, name
        assert stage(spark, rows.limit(0), DIR).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, rows.limit(0), DIR).collect() == []


def test_rows_without_or_with_a_shared_doc_id_are_judged_too(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    item = max((r.text or "" for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()), key=len)
    base = [f"word{i}" for i in range(60)]
    near = " ".join([*base[:-1], "other"])
    texts = {"named": (1, " ".join(base)), "near": (None, near), "exact": (None, " ".join(base)), "dirty": (None, item),
             "one": (7, " ".join(f"x{i}" for i in range(40))), "two": (7, " ".join(f"y{i}" for i in range(40))), "clean": (None, " ".join(f"z{i}" for i in range(40)))}
    rows = spark.createDataFrame([(i, t, "en", name, len(t)) for name, (i, t) in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, rows, DIR)
    assert kept.columns == rows.columns and docs.columns == rows.columns
    assert {r.source for r in kept.collect()} == {"named", "dirty", "one", "two", "clean"}
    assert {r.source for r in corpus_pipeline.decontamination(spark, rows, DIR).collect()} == texts.keys() - {"dirty"}
