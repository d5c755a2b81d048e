"""Pipeline inputs derived, with Spark, from the driver's test tables.

The original pipeline consumes a scraped catalog, model replies and model
embeddings that are not part of the test data.  Each function here re-shapes
one of the given tables (``part``, ``embeddings``, ``events``) into that input,
row for row: every source row contributes, nothing is sampled or capped, so
the work grows with the tables.  Variety (missing values, unknowns, invalid
JSON, duplicated keys) is derived from data columns.

Every derivation has an SQL twin in ``plans/oracle.py`` that DuckDB runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TAG_IMAGE, TAG_NAME, TAG_TEXT
from ..session import staging_path, track_staging
from ..sources.images import save_factory

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Category links used by the synthetic catalog: one per part type except
# PROMO, which is left out of the dictionary on purpose (unmapped -> null).
FIXTURE_CATEGORY_BASE = "https://shop.example/c/"
FIXTURE_CATEGORY_MAP = {
    FIXTURE_CATEGORY_BASE + "ECONOMY": "이코노미",
    FIXTURE_CATEGORY_BASE + "LARGE": "라지",
    FIXTURE_CATEGORY_BASE + "MEDIUM": "미디엄",
    FIXTURE_CATEGORY_BASE + "SMALL": "스몰",
    FIXTURE_CATEGORY_BASE + "STANDARD": "스탠다드",
}
FIXTURE_IMAGE_DIR = "/data/catalog/"
PICTURE_FOLDERS = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def entities_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """Vector entities: five consecutive vectors form one product.

    ``prd_id = vec_id div 5``; by ``vec_id % 5``: 0 is the name vector, 1-2 text
    vectors, 3-4 image vectors (so "first text vector" is meaningful).
    """
    slot = F.col("vec_id") % 5
    tag = (
        F.when(slot == 0, F.lit(TAG_NAME))
        .when(slot <= 2, F.lit(TAG_TEXT))
        .otherwise(F.lit(TAG_IMAGE))
    )
    return embeddings.select(
        F.col("vec_id").alias("id"),
        F.expr("vec_id div 5").cast("string").alias("prd_id"),
        tag.alias("prd_tag"),
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("prd_text"),
        F.col("embedding"),
    )


def entities_by_label(embeddings: DataFrame) -> DataFrame:
    """Vector entities whose tag follows the data's ``label`` column.

    ``prd_id = vec_id div 5``; label 0-1: name vector, 2-5: text vector,
    6-9: image vector.  Products then hold 0..5 vectors of a tag, so some have
    several name vectors (the lowest id is the query) and some lack a tag
    entirely (they cannot be scored and become rejects).
    """
    label = F.col("label")
    tag = (
        F.when(label <= 1, F.lit(TAG_NAME))
        .when(label <= 5, F.lit(TAG_TEXT))
        .otherwise(F.lit(TAG_IMAGE))
    )
    return embeddings.select(
        F.col("vec_id").alias("id"),
        F.expr("vec_id div 5").cast("string").alias("prd_id"),
        tag.alias("prd_tag"),
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("prd_text"),
        F.col("embedding"),
    )


def entities_skewed(embeddings: DataFrame) -> DataFrame:
    """``entities_by_label`` with a third of all vectors re-keyed onto one product."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("prd_id"))
    return entities_by_label(embeddings).withColumn("prd_id", hot)


def unnamed_catalog(product_raw: DataFrame) -> DataFrame:
    """Products of which some lost their name and some their image path (by the name's length)."""
    size = F.length("prd_name")
    return product_raw.withColumns(
        {
            "prd_img": F.when(size % 5 != 0, F.col("prd_img")),
            "prd_name": F.when(size % 7 != 0, F.col("prd_name")),
        }
    )


def _picture_path(key: Column) -> Column:
    """Path of a picture below its folder: tasks that make files in one folder wait for each other, so there are many."""
    return F.concat(F.lit("prd_img/"), F.lpad(F.hex(F.pmod(F.xxhash64(key), F.lit(PICTURE_FOLDERS))), 3, "0"), F.lit("/"), key, F.lit(".jpg"))


def write_pictures(documents: DataFrame) -> str:
    """Documents as picture files in the staging folder, written by the tasks; every third text length has no file.

    Returns the folder; the file of a document is ``prd_img/<hash>/<doc_id>.jpg`` in it.  A repeated task writes the same bytes.
    """
    folder = track_staging(staging_path(documents.sparkSession, "pictures"))

    def write(batches):
        import pandas as pd

        save = save_factory()
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"]):
                if path is not None:
                    save(f"{folder}/{path}", text.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = documents.where(F.length("text") % 3 != 0).select(_picture_path(F.col("doc_id").cast("string")).alias("path"), "text")
    rows.mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return folder


def picture_products(documents: DataFrame, folder: str) -> DataFrame:
    """A product per document, with the path its picture should have."""
    key = F.col("doc_id").cast("string")
    return documents.select(key.alias("prd_id"), F.concat(F.lit(f"{folder}/"), _picture_path(key)).alias("prd_img"))


def write_catalog_csv(part: DataFrame) -> str:
    """``raw_catalog`` as CSV files in the staging folder, with line breaks and quotes inside some names; returns the folder."""
    folder = track_staging(staging_path(part.sparkSession, "csv"))
    raw = raw_catalog(part)
    size = F.length("name")
    name = F.when(size % 3 == 0, F.replace("name", F.lit(" "), F.lit("\n"))).when(size % 3 == 1, F.concat(F.lit('"'), "name", F.lit('",\n'))).otherwise(F.col("name"))
    raw.withColumn("name", name).write.options(header=True, quote='"', escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    return folder


def _word(col: Column, i: int) -> Column:
    return F.split_part(col, F.lit(" "), F.lit(i))


def raw_catalog(part: DataFrame) -> DataFrame:
    """A scraped-catalog frame (all strings, original CSV headers) from ``part``.

    price: thousands-separated integer plus the currency sign; rating: the
    size in parentheses, with a thousands separator for large values (which
    therefore cannot be cast) and the pandas NA token ``N/A`` when the size is
    a multiple of 7; ratingValue: one decimal, empty when the size is a
    multiple of 11.
    """
    key = F.col("p_partkey")
    size = F.col("p_size")
    price_num = key * F.lit(137) + F.lit(9000)
    rating = (
        F.when(size % 7 == 0, F.lit("N/A"))
        .otherwise(F.concat(F.lit("("), F.format_number(size * F.lit(40), 0), F.lit(")")))
    )
    rating_value = F.when(size % 11 == 0, F.lit("")).otherwise(
        F.format_string("%d.%d", size % 5, size % 10)
    )
    return part.select(
        key.cast("string").alias("web-scraper-order"),
        F.concat(F.lit(FIXTURE_CATEGORY_BASE), F.col("p_type")).alias("category-link-0-href"),
        F.col("p_name").alias("name"),
        F.concat(F.format_number(price_num, 0), F.lit("원")).alias("price3"),
        rating.alias("rating"),
        rating_value.alias("ratingValue"),
        F.concat(F.lit("https://img.example/"), key.cast("string"), F.lit(".jpg")).alias("image-src"),
        F.concat(F.lit("https://img.example/d/"), F.col("p_brand")).alias("image2-src"),
    )


def raw_catalog_with_duplicates(part: DataFrame) -> DataFrame:
    """``raw_catalog`` plus a renamed second copy of every part larger than 40,
    with an explicit input ordinal ``_ord``.  The copy comes first when the
    size is even (so the copy wins) and last otherwise."""
    base = raw_catalog(part).withColumn("_ord", F.col("web-scraper-order").cast("long") * 3 + 1)
    dup_part = part.where(F.col("p_size") > 40)
    dup = (
        raw_catalog(dup_part.withColumn("p_name", F.concat(F.col("p_name"), F.lit(" v2"))))
        .join(dup_part.select(F.col("p_partkey").cast("string").alias("web-scraper-order"), "p_size"), "web-scraper-order")
        .withColumn(
            "_ord",
            F.col("web-scraper-order").cast("long") * 3
            + F.when(F.col("p_size") % 2 == 0, F.lit(0)).otherwise(F.lit(2)),
        )
        .drop("p_size")
    )
    return base.unionByName(dup)


def existing_catalog_keys(part: DataFrame) -> DataFrame:
    """Keys already present in the target table before an insert: the SMALL parts."""
    return part.where(F.col("p_type") == "SMALL").select(F.col("p_partkey").cast("string").alias("prd_id"))


def replies(part: DataFrame, side: str) -> DataFrame:
    """Model replies ``(prd_id, status, content, error)`` for every part.

    ``side`` is ``text`` or ``image`` and changes the wording so the two trait
    tables differ.  Shape by data:
      * status false (an error message, no content) for brand ``Brand#13``;
      * prose around a JSON array of one object, two objects when the size is
        even; keys missing when the size is a multiple of 5; ``unknown``
        values when the size is a multiple of 7;
      * a nested object (dropped by the contract) for type MEDIUM;
      * an over-long ``material`` for sizes over 45 (width-rule rejects);
      * no JSON at all for type PROMO on the image side.
    """
    size = F.col("p_size")
    first, second = _word(F.col("p_name"), 1), _word(F.col("p_name"), 2)
    if side == "text":
        cat1, cat2, style = second, F.col("p_type"), first
    else:
        cat1, cat2, style = F.lower(F.col("p_type")), second, F.concat(first, F.lit(" look"))
    unknown = size % 7 == 0
    missing = size % 5 == 0

    def q(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    occasion = F.when(unknown, q(F.lit("unknown"))).otherwise(q(F.lit("daily")))
    material = F.when(size > 45, q(F.repeat(F.concat(first, F.lit("-")), 12))).otherwise(q(F.col("p_brand")))
    obj1 = F.concat(
        F.lit('{"category1": '),
        q(cat1),
        F.lit(', "category2": '),
        F.when(unknown, q(F.lit("unknown"))).otherwise(q(cat2)),
        F.lit(', "color": '),
        q(first),
        F.when(missing, F.lit("")).otherwise(F.concat(F.lit(', "style": '), q(style))),
        F.lit(', "material": '),
        material,
        F.lit(', "occasion": '),
        occasion,
        F.lit("}"),
    )
    obj2 = F.concat(
        F.lit('{"category1": '),
        q(second),
        F.lit(', "color": '),
        q(F.col("p_brand")),
        F.lit(', "size": '),
        size.cast("string"),
        F.lit("}"),
    )
    nested = F.lit('{"category1": {"inner": "x"}, "color": "red"}')
    array_body = F.concat(
        F.lit("[\n  "),
        obj1,
        F.when(size % 2 == 0, F.concat(F.lit(",\n  "), obj2)).otherwise(F.lit("")),
        F.when(F.col("p_type") == "MEDIUM", F.concat(F.lit(",\n  "), nested)).otherwise(F.lit("")),
        F.lit("\n]"),
    )
    content = F.concat(F.lit(f"Here is what I see in the {side}:\n"), array_body, F.lit("\nHope this helps."))
    if side == "image":
        content = F.when(F.col("p_type") == "PROMO", F.lit("I cannot tell anything about it.")).otherwise(content)
    failed = F.col("p_brand") == "Brand#13"
    return part.select(
        F.col("p_partkey").cast("string").alias("prd_id"),
        (~failed).alias("status"),
        F.when(failed, F.lit(None).cast("string")).otherwise(content).alias("content"),
        F.when(failed, F.lit("model endpoint timed out")).otherwise(F.lit(None).cast("string")).alias("error"),
    )
