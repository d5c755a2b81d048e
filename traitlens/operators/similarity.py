"""Product-local vector similarity (entity lookup, first vectors, scores, top-k).

Entities are rows ``(id, prd_id, prd_tag, embedding[, norm])``.  Every
comparison stays inside one product: the query vectors of a product are only
compared with that product's own entities, so the work is linear in the number
of entities (one query vector per product and tag, never all pairs).

Plan shape, the same for every size: rows without product or id are rejects; the first name and text vectors of a product
(lowest id, ties by the vector itself) come from one map-side combined ``min``; the candidates are joined with them on
prd_id by ``skew.split_join``, which deals the candidates of a product that holds more than a mean shuffle partition over
salts (``hot_key_rows`` sets another size), with the same result.  A row carries its own vector only once through each
exchange.  Each (candidate, search it belongs to) gets one cosine - text candidates take part in one search, image
candidates in two - followed by a conditional ``max`` per product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import TAG_IMAGE, TAG_NAME, TAG_TEXT
from ..functions.vectors import cosine, norm, resolve_impl
from ..session import cut_lineage
from .skew import split_join

# (output column, query tag, candidate tag) — the three product-local measures.
SCORE_PAIRS = (
    ("similarity_name_text", TAG_NAME, TAG_TEXT),
    ("similarity_name_image", TAG_NAME, TAG_IMAGE),
    ("similarity_text_image", TAG_TEXT, TAG_IMAGE),
)


def with_norm(entities: DataFrame, impl: str | None = None) -> DataFrame:
    """Add the vector norm once per entity; a stored norm is kept, a missing one computed."""
    if "norm" in entities.columns:
        return entities.withColumn("norm", F.coalesce(F.col("norm"), norm("embedding", impl)))
    return entities.withColumn("norm", norm("embedding", impl))


def _scoring_input(entities: DataFrame) -> DataFrame:
    """Entities as the scoring plan reads them.

    Native kernel: a norm per entity (stored or computed once) so each pair
    only needs a dot product.  Arrow kernel: norms come out of the same batch
    pass as the dot product, so none is computed on the scan side.
    """
    if resolve_impl() == "native":
        return with_norm(entities, "native")
    if "norm" in entities.columns:
        return entities
    return entities.withColumn("norm", F.lit(None).cast("double"))


def lookup(entities: DataFrame, tags=(TAG_NAME, TAG_TEXT)) -> DataFrame:
    """Batch form of the (tag, product) entity lookup: every entity of the given tags."""
    return entities.where(F.col("prd_tag").isin(list(tags)))


KEYED = "prd_id is not null and id is not null"


def first_vectors(entities: DataFrame, tags=(TAG_NAME, TAG_TEXT)) -> DataFrame:
    """One row per product: for each tag, the entity with the lowest id (equal ids: the least vector).

    Columns ``prd_id`` and ``q_<tag>`` = struct(id, embedding, norm), null when
    the product has no entity of that tag.
    """
    ent = _scoring_input(entities).where(KEYED).where(F.col("prd_tag").isin(list(tags)))
    payload = F.struct("id", "embedding", "norm")
    return ent.groupBy("prd_id").agg(*[F.min(F.when(F.col("prd_tag") == F.lit(tag), payload)).alias(f"q_{tag}") for tag in tags])


def _pair_frame(entities: DataFrame, hot_key_rows: int | None) -> DataFrame:
    """Candidates (text and image entities) with their product's query vectors."""
    ent = _scoring_input(entities).select("prd_id", "id", "prd_tag", "embedding", "norm").where(KEYED)
    queries = first_vectors(ent, (TAG_NAME, TAG_TEXT))
    cands = ent.where(F.col("prd_tag").isin(TAG_TEXT, TAG_IMAGE))
    return split_join(cands, queries, "prd_id", ["id", "prd_tag"], hot_key_rows)


def _search_hits(pairs: DataFrame, searches=SCORE_PAIRS) -> DataFrame:
    """One row per (candidate, search it takes part in), with its cosine.

    A text candidate is in one search, an image candidate in two; the query
    vector is chosen per row before the cosine, so each pair is computed once
    (a vector kernel inside CASE WHEN would run for every row anyway).
    """
    items = [
        F.when(
            F.col("prd_tag") == F.lit(c),
            F.struct(
                F.lit(name.replace("similarity_", "")).alias("search"),
                F.col(f"q_{q}")["embedding"].alias("qv"),
                F.col(f"q_{q}")["norm"].alias("qn"),
            ),
        )
        for name, q, c in searches
    ]
    rows = pairs.select(
        "prd_id",
        "id",
        "prd_tag",
        "embedding",
        "norm",
        F.explode(F.filter(F.array(*items), lambda s: s.isNotNull() & s["qv"].isNotNull())).alias("s"),
    )
    return rows.select(
        "prd_id",
        F.col("s.search").alias("search"),
        "id",
        "prd_tag",
        cosine(F.col("s.qv"), F.col("embedding"), F.col("s.qn"), F.col("norm")).alias("similarity"),
    )


def similarity_inner(
    entities: DataFrame, hot_key_rows: int | None = None, materialize: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Scores of how well a product's name, text traits and image traits agree.

    ``similarity_name_text``  = max cos(first name vector, each text vector)
    ``similarity_name_image`` = max cos(first name vector, each image vector)
    ``similarity_text_image`` = max cos(first text vector, each image vector)

    Returns ``(scores, rejects)``.  A product that lacks a tag is rejected as ``missing_tag``, one whose vectors have no
    direction (zero length) as ``zero_vector``, and an entity without product or id as ``null_key``.
    """
    hits = _search_hits(_pair_frame(entities, hot_key_rows))
    names = [name for name, _, _ in SCORE_PAIRS]
    aggs = [F.max(F.when(F.col("search") == F.lit(name.replace("similarity_", "")), F.col("similarity"))).alias(name) for name in names]
    scored = hits.groupBy("prd_id").agg(*aggs)
    if materialize:  # the rejects below read the scores: compute them once
        scored = cut_lineage(scored, "similarity")
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    scores = scored.where(complete)
    tags = [F.max(F.when(F.col("prd_tag") == F.lit(tag), True)).alias(f"has_{tag}") for tag in (TAG_NAME, TAG_TEXT, TAG_IMAGE)]
    products = entities.where(KEYED).groupBy("prd_id").agg(*tags).join(scored, "prd_id", "left").where(~complete)
    every = F.col(f"has_{TAG_NAME}") & F.col(f"has_{TAG_TEXT}") & F.col(f"has_{TAG_IMAGE}")
    rule = F.when(every, "zero_vector").otherwise("missing_tag")
    incomplete = products.select(
        F.lit("similarity").alias("stage"),
        F.col("prd_id"),
        rule.alias("rule"),
        F.when(every, "embedding").otherwise("prd_tag").alias("column_name"),
        F.when(every, "a needed vector has no direction").otherwise("product lacks a name, text or image vector").alias("detail"),
    )
    unkeyed = entities.where(f"not ({KEYED})")
    column = F.when(F.col("prd_id").isNull(), "prd_id").otherwise("id")
    nulls = unkeyed.select(
        F.lit("similarity").alias("stage"), F.col("prd_id").cast("string").alias("prd_id"), F.lit("null_key").alias("rule"),
        column.alias("column_name"), F.lit("null").alias("detail"),
    )
    return scores, incomplete.unionByName(nulls)


def topk_inner(
    entities: DataFrame,
    k: int = 10,
    searches=SCORE_PAIRS,
    hot_key_rows: int | None = None,
) -> DataFrame:
    """Filtered top-k search restricted to each product's own entities.

    For every product and search ``(name, query tag, candidate tag)``: the
    candidates of that tag ranked by cosine to the product's first query-tag
    vector, descending, ties by entity id; ranks 1..k are kept (the limit is
    the feature).  Spark plans a partial per-product limit before the shuffle.
    """
    hits = _search_hits(_pair_frame(entities, hot_key_rows), searches)
    order = Window.partitionBy("prd_id", "search").orderBy(F.desc_nulls_last("similarity"), F.asc("id"))
    ranked = hits.withColumn("rank", F.row_number().over(order))
    # Undefined similarities (zero-length vectors) rank after every defined one,
    # so dropping them after ranking leaves the ranks of the others unchanged.
    # Filtering before the window would be pushed below the projection and make
    # Spark evaluate the vector kernel twice.
    return ranked.where((F.col("rank") <= k) & F.col("similarity").isNotNull())
