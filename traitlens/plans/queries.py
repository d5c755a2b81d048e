"""Named queries over the driver's test tables (one per operator family).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the SQL twin in ``plans/oracle.py``.  Floating-point
results are rounded to 6 decimals so the two engines hash equal values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import extract_json_objects
from ..operators import catalog, entities, inference, integrate, requests, similarity, traits
from ..session import cut_lineage, staging_path, track_staging
from ..sources.catalog_csv import read_catalog_csv
from ..sources.tables import TableStore
from . import doubles
from . import fixtures as fx

ROUND = 6


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.entities_from_embeddings(fx.read_table(spark, sf_dir, "embeddings"))


def q_similarity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = similarity.similarity_inner(_entities(spark, sf_dir))
    return scores.select(
        "prd_id",
        *[F.round(c, ROUND).alias(c) for c in ("similarity_name_text", "similarity_name_image", "similarity_text_image")],
    )


def q_vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = similarity.topk_inner(_entities(spark, sf_dir), k=10)
    return hits.select("prd_id", "search", "rank", "id", "prd_tag", F.round("similarity", ROUND).alias("similarity"))


def q_similarity_scores_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = fx.entities_by_label(fx.read_table(spark, sf_dir, "embeddings"))
    scores, _ = similarity.similarity_inner(ent)
    return scores.select(
        "prd_id",
        *[F.round(c, ROUND).alias(c) for c in ("similarity_name_text", "similarity_name_image", "similarity_text_image")],
    )


def q_similarity_scores_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all vectors belongs to one product."""
    scores, _ = similarity.similarity_inner(fx.entities_skewed(fx.read_table(spark, sf_dir, "embeddings")))
    return scores.select(
        "prd_id",
        *[F.round(c, ROUND).alias(c) for c in ("similarity_name_text", "similarity_name_image", "similarity_text_image")],
    )


def q_similarity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = fx.entities_by_label(fx.read_table(spark, sf_dir, "embeddings"))
    _, rejects = similarity.similarity_inner(ent)
    return rejects.select("stage", "prd_id", "rule", "column_name")


def q_vector_top1_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k = 1: each search keeps only its best candidate, so the limit is exercised."""
    hits = similarity.topk_inner(_entities(spark, sf_dir), k=1)
    return hits.select("prd_id", "search", "rank", "id", "prd_tag", F.round("similarity", ROUND).alias("similarity"))


def q_vector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent = similarity.with_norm(_entities(spark, sf_dir))
    found = similarity.lookup(ent)
    return found.select(
        "prd_id",
        "prd_tag",
        "id",
        F.size("embedding").cast("long").alias("dim"),
        F.round("norm", ROUND).alias("norm"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "similarity_scores": q_similarity_scores,
    "vector_topk_filtered": q_vector_topk_filtered,
    "vector_top1_filtered": q_vector_top1_filtered,
    "similarity_scores_by_label": q_similarity_scores_by_label,
    "similarity_scores_skewed": q_similarity_scores_skewed,
    "similarity_rejects": q_similarity_rejects,
    "vector_lookup": q_vector_lookup,
}


# --- trait extraction ---------------------------------------------------------

def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.read_table(spark, sf_dir, "part")


def q_trait_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = traits.extract_traits(fx.replies(_part(spark, sf_dir), "text"), "text")
    return valid


def q_extract_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = traits.split_replies(fx.replies(_part(spark, sf_dir), "text"), "traits_text")
    return traits.object_counts(ok)


def q_json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.read_table(spark, sf_dir, "events")
    objs = events.select("event_id", F.explode(extract_json_objects(F.col("props"), ("k",))).alias("o"))
    return objs.select("event_id", F.col("o")["k"].alias("k"))


def q_replies_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    out = None
    for side in ("text", "image"):
        stage = f"traits_{side}"
        ok, rejects = traits.split_replies(fx.replies(part, side), stage)
        routed = ok.select(
            "prd_id", F.lit(stage).alias("stage"), F.lit("parse").alias("route"), F.col("error").alias("detail")
        ).unionByName(rejects.select("prd_id", "stage", F.lit("reject").alias("route"), "detail"))
        out = routed if out is None else out.unionByName(routed)
    return out


# --- catalog ------------------------------------------------------------------

def _clean(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return catalog.clean_catalog(raw, fx.FIXTURE_IMAGE_DIR, fx.FIXTURE_CATEGORY_MAP)


def _as_double(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def q_catalog_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = _clean(fx.raw_catalog(_part(spark, sf_dir)))
    return _as_double(valid, catalog.NUMERIC_COLUMNS)


def q_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    valid, _ = _clean(fx.raw_catalog_with_duplicates(part))
    appended = catalog.insert_ignore(valid, fx.existing_catalog_keys(part))
    return appended.select("prd_id", "prd_name", F.col("price").cast("double").alias("price"))


QUERIES.update(
    {
        "trait_extract": q_trait_extract,
        "extract_json_array": q_extract_json_array,
        "json_props_extract": q_json_props_extract,
        "replies_split": q_replies_split,
        "catalog_clean": q_catalog_clean,
        "insert_ignore": q_insert_ignore,
    }
)


# --- integration, documents, rejects, requests ----------------------------------

def _product_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _clean(fx.raw_catalog(_part(spark, sf_dir)))


def _traits(spark: SparkSession, sf_dir: str, side: str, both: bool = False) -> tuple[DataFrame, DataFrame]:
    """Traits and rejects; where ``both`` are read, or one twice, the replies are parsed once, by all cores, and the tagged
    rows written."""
    part = _part(spark, sf_dir)
    if both:  # a scan of so narrow a table has few tasks, and parsing is the work
        part = part.repartition(4 * spark.sparkContext.defaultParallelism)
    return traits.extract_traits(fx.replies(part, side), side, materialize=both)


def _integrated(spark: SparkSession, sf_dir: str, both: bool = False) -> DataFrame:
    text, image = (_traits(spark, sf_dir, side, both)[0] for side in ("text", "image"))
    return integrate.integrate_traits(_product_raw(spark, sf_dir)[0], text, image)[0]


def q_integrate_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir)


def q_masked_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    integrated = _integrated(spark, sf_dir)
    return integrated.select("prd_id", "trait_side", entities.trait_document().alias("trait_doc"))


def q_entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.entity_documents(_integrated(spark, sf_dir))


def q_distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate.pair_counts(_integrated(spark, sf_dir))


def q_quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, catalog_rejects = _product_raw(spark, sf_dir)
    text, text_rejects = _traits(spark, sf_dir, "text", both=True)
    image, image_rejects = _traits(spark, sf_dir, "image", both=True)
    integrate_rejects = integrate.integrate_traits(raw, text, image)[1]
    return catalog_rejects.unionByName(text_rejects).unionByName(image_rejects).unionByName(integrate_rejects)


def q_requests_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = fx.unnamed_catalog(_product_raw(spark, sf_dir)[0])
    reqs = requests.text_requests(products, requests.ChatSettings(model="trait-model"))
    return reqs.select(
        "prd_id",
        F.get_json_object("request", "$.model").alias("model"),
        F.get_json_object("request", "$.messages[1].content[0].text").alias("user_text"),
        F.json_array_length(F.get_json_object("request", "$.messages")).alias("n_messages"),
    )


def q_data_url_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = requests.data_url(F.col("text").cast("binary"))
    return fx.read_table(spark, sf_dir, "documents").select("doc_id", F.length(url).alias("url_chars"), F.sha2(url, 256).alias("url_sha256"))


def _picture_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as picture files: requests that name the file, rejects where there is none."""
    docs = fx.read_table(spark, sf_dir, "documents")
    present, missing = requests.attach_pictures(fx.picture_products(docs, fx.write_pictures(docs)))
    return requests.image_requests(present, requests.ChatSettings(model="trait-model")), missing


def q_requests_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each document that has a picture file, as it is sent, and a reject for each that has none."""
    reqs, missing = _picture_requests(spark, sf_dir)
    content = "$.messages[1].content"
    return inference.bound_requests(reqs, tasks=4 * spark.sparkContext.defaultParallelism).select(
        "prd_id",
        F.get_json_object("request", f"{content}[0].text").alias("question"),
        F.sha2(F.get_json_object("request", f"{content}[1].image_url.url"), 256).alias("url_sha256"),
        F.lit(None).cast("string").alias("reject"),
    ).unionByName(
        missing.select("prd_id", F.lit(None).cast("string").alias("question"), F.lit(None).cast("string").alias("url_sha256"), F.col("rule").alias("reject"))
    )


def q_catalog_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog written as CSV files with line breaks inside quotes, and read back in splits."""
    return read_catalog_csv(spark, fx.write_catalog_csv(_part(spark, sf_dir)), with_ordinal=False).select(
        F.col("`web-scraper-order`").alias("prd_id"), "name", F.col("price3").alias("price"), "rating", F.col("ratingValue").alias("rating_value"),
        F.col("`image2-src`").alias("image2"),
    )


QUERIES.update(
    {
        "integrate_traits": q_integrate_traits,
        "masked_concat": q_masked_concat,
        "entity_documents": q_entity_documents,
        "distinct_products": q_distinct_products,
        "quality_rejects": q_quality_rejects,
        "requests_text": q_requests_text,
        "data_url_documents": q_data_url_documents,
        "requests_image": q_requests_image,
        "catalog_csv_scan": q_catalog_csv_scan,
    }
)


# --- model jobs (plugged with deterministic doubles) ------------------------------

ENCODE_DIM = 1 + len(doubles.LETTERS)


def _inferred_text_traits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = _product_raw(spark, sf_dir)[0]
    reqs = requests.text_requests(raw, requests.ChatSettings(model="trait-model"))
    replies = inference.run_chat_job(reqs, doubles.echo_trait_client_factory, max_in_flight=4, tasks=spark.sparkContext.defaultParallelism)
    return traits.extract_traits(replies, "text")


def q_infer_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = _inferred_text_traits(spark, sf_dir)
    return valid


def q_infer_image_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image model job through a log of replies: pictures are read where their request is sent."""
    reqs, _ = _picture_requests(spark, sf_dir)
    log = inference.chat_log(spark, track_staging(staging_path(spark, "replies")))
    replies = inference.resume_chat_job(reqs, log, doubles.picture_trait_client_factory, max_in_flight=4, tasks=spark.sparkContext.defaultParallelism)
    return traits.extract_traits(replies, "image")[0]


def _encoded_entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents through the encoder job; vectors of texts whose length is a multiple of 11 lose their last number (V3)."""
    docs = cut_lineage(entities.entity_documents(_integrated(spark, sf_dir, both=True)), "documents")  # read for the encoder and for the join back
    encoded = inference.encode_documents(docs, doubles.letter_encoder_factory, text_col="prd_text")
    short = F.when(F.length("prd_text") % 11 == 0, F.slice("embedding", 1, ENCODE_DIM - 1)).otherwise(F.col("embedding"))
    return entities.to_entities(encoded.withColumn("embedding", short), ENCODE_DIM, materialize=True)


def q_encode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ent, rejects = _encoded_entities(spark, sf_dir)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return ent.select("id", "prd_id", "prd_tag", "prd_text", total.alias("vector_sum"), F.round("norm", ROUND).alias("norm"), F.lit(None).cast("string").alias("reject")).unionByName(
        rejects.select(
            F.lit(None).cast("long").alias("id"), "prd_id", F.lit(None).cast("string").alias("prd_tag"), F.lit(None).cast("string").alias("prd_text"),
            F.lit(None).cast("double").alias("vector_sum"), F.lit(None).cast("double").alias("norm"), F.concat_ws(" ", "rule", "detail").alias("reject"),
        )
    )


def q_end_to_end_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = similarity.similarity_inner(_encoded_entities(spark, sf_dir)[0])
    return scores.select(
        "prd_id",
        *[F.round(c, ROUND).alias(c) for c in ("similarity_name_text", "similarity_name_image", "similarity_text_image")],
    )


QUERIES.update(
    {
        "infer_traits": q_infer_traits,
        "infer_image_traits": q_infer_image_traits,
        "encode_entities": q_encode_entities,
        "end_to_end_scores": q_end_to_end_scores,
    }
)


# --- tables written in two runs and read back --------------------------------------

def _in_two_runs(rows: DataFrame, name: str, stale: str, value) -> DataFrame:
    """``rows`` through the table store: a first run holds three quarters of the products, a third of them with a stale
    column; a second one replaces the stale products and brings the others."""
    spark = rows.sparkSession
    store = TableStore(spark, track_staging(staging_path(spark, "store")))
    store.create_all()
    rows = cut_lineage(rows.withColumn("quarter", F.pmod(F.xxhash64("prd_id"), F.lit(4))), "rows")
    late = F.col("quarter") >= 2
    with store.publish("first"):
        old = F.when(F.col("quarter") == 2, value).otherwise(F.col(stale)).alias(stale)
        store.write(rows.where("quarter < 3").select(*(old if c == stale else c for c in rows.columns if c != "quarter")), name)
    with store.publish("second", keys=rows.where(late).select("prd_id")):
        store.write(rows.where(late).drop("quarter"), name)
    return store.read(name)


def q_stored_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, image = (
        _in_two_runs(_traits(spark, sf_dir, side)[0], f"products_trait_{side}", "style", F.lit("stale")).withColumn("side", F.lit(side)) for side in ("text", "image")
    )
    return text.unionByName(image)


def q_stored_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_two_runs(_integrated(spark, sf_dir), "products_trait_information", "prd_name", F.lit("stale"))


def q_stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = similarity.similarity_inner(_entities(spark, sf_dir))
    names = ("similarity_name_text", "similarity_name_image", "similarity_text_image")
    return _in_two_runs(scores.select("prd_id", *names), "products_similarity_score_inner", names[0], F.lit(2.0)).select(
        "prd_id", *[F.round(c, ROUND).alias(c) for c in names]
    )


QUERIES.update({"stored_traits": q_stored_traits, "stored_information": q_stored_information, "stored_scores": q_stored_scores})
