"""Chat requests for the trait models, built as nested columns.

A request is ``struct(model, temperature, messages)`` serialised with
``to_json`` at the boundary to the model job.  The text request asks about
the product name; the image request names the picture by its path, and the
model job puts the bytes in its place as a base64 data URL when it sends the
request, so no picture is stored twice.  A catalog row whose file is missing
becomes a reject instead of an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DATA_URL_PREFIX,
    DEFAULT_TEMPERATURE,
    IMAGE_QUESTION,
    TEXT_QUESTION_PREFIX,
    TEXT_QUESTION_SUFFIX,
)
from ..session import cut_lineage
from ..sources.images import Stat, stat_factory, stat_pictures
from .quality import reject_frame

# Default role prompt (our own wording; users supply theirs).
DEFAULT_ROLE_PROMPT = (
    "You describe fashion products. Answer with one JSON object with the keys "
    "category1, category2, color, style, material and occasion, one value each. "
    'Use "unknown" for any attribute you are not sure about.'
)


@dataclass(frozen=True)
class ChatSettings:
    """Model configuration captured by the request builders (no secrets here)."""

    model: str
    role_prompt: str = DEFAULT_ROLE_PROMPT
    temperature: float = DEFAULT_TEMPERATURE


def _part(kind: str, text: Column | None = None, url: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        (text if text is not None else F.lit(None).cast("string")).alias("text"),
        (F.struct(url.alias("url")) if url is not None else F.lit(None).cast("struct<url:string>")).alias(
            "image_url"
        ),
    )


def _request(settings: ChatSettings, user_parts: list[Column]) -> Column:
    system = F.struct(F.lit("system").alias("role"), F.array(_part("text", F.lit(settings.role_prompt))).alias("content"))
    user = F.struct(F.lit("user").alias("role"), F.array(*user_parts).alias("content"))
    return F.to_json(
        F.struct(
            F.lit(settings.model).alias("model"),
            F.lit(float(settings.temperature)).alias("temperature"),
            F.array(system, user).alias("messages"),
        )
    )


def text_question(name: Column) -> Column:
    return F.concat(F.lit(TEXT_QUESTION_PREFIX), name, F.lit(TEXT_QUESTION_SUFFIX))


def text_requests(product_raw: DataFrame, settings: ChatSettings) -> DataFrame:
    """``(prd_id, request)`` for named catalog rows with an image path (the original gate)."""
    rows = product_raw.where(F.col("prd_img").isNotNull() & F.col("prd_name").isNotNull())
    return rows.select("prd_id", _request(settings, [_part("text", text_question(F.col("prd_name")))]).alias("request"))


def unnamed_rejects(product_raw: DataFrame) -> DataFrame:
    """Rows with an image path that cannot be asked about because they have no name."""
    rows = product_raw.where(F.col("prd_img").isNotNull() & F.col("prd_name").isNull())
    return reject_frame(rows, "text_requests", "not_null", "prd_name", F.lit("null"))


def base64_plain(content: Column) -> Column:
    """Base64 without line breaks (Spark's encoder may wrap with CRLF)."""
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")


def data_url(content: Column) -> Column:
    return F.concat(F.lit(DATA_URL_PREFIX), base64_plain(content))


def normalise_path(path: Column) -> Column:
    """``file:/a/b.jpg`` / ``file:///a/b.jpg`` (as a binaryFile scan reports) -> ``/a/b.jpg``."""
    return F.regexp_replace(path, r"^file:(//)?", "")


def attach_pictures(product_raw: DataFrame, stats: Callable[[], Stat] = stat_factory) -> tuple[DataFrame, DataFrame]:
    """``(prd_id, prd_img, picture)`` of the catalog rows whose picture file is there, and rejects for the others.

    Files are looked up one by one in the tasks (``sources.images.stat_pictures``) and the answers written, as both results
    read them.  ``picture`` is the file's version; no bytes are read.
    """
    rows = product_raw.where(F.col("prd_img").isNotNull()).select("prd_id", "prd_img")
    known = cut_lineage(stat_pictures(rows, "prd_img", stats), "pictures")
    missing = known.where(F.col("picture").isNull())
    return known.where(F.col("picture").isNotNull()), reject_frame(missing, "image_requests", "missing_image", "prd_img", F.col("prd_img"))


def attach_images(product_raw: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Join catalog rows to image bytes by path; missing files -> rejects.

    ``images`` is a ``binaryFile`` scan (``path``, ``content``, ...).  Paths of both sides are normalised.  Missing files are
    found by path alone, so the bytes are read only for the rows that are present.  For folders small enough to list;
    ``attach_pictures`` needs no listing and moves no bytes.
    """
    key = normalise_path(F.col("path")).alias("_path")
    rows = product_raw.where(F.col("prd_img").isNotNull()).select("prd_id", "prd_img", normalise_path(F.col("prd_img")).alias("_path"))
    present = rows.join(images.select(key, "content"), "_path").select("prd_id", "prd_img", "content")
    missing = rows.join(images.select(key), "_path", "left_anti")
    return present, reject_frame(missing, "image_requests", "missing_image", "prd_img", F.col("prd_img"))


def image_requests(with_pictures: DataFrame, settings: ChatSettings) -> DataFrame:
    """``(prd_id, request[, picture])`` about the picture at ``prd_img``.

    A frame with ``content`` (bytes, from ``attach_images``) gives requests that carry the picture; one without gives requests
    that name it, and the model job binds it.
    """
    url = data_url(F.col("content")) if "content" in with_pictures.columns else F.col("prd_img")
    parts = [_part("text", F.lit(IMAGE_QUESTION)), _part("image_url", url=url)]
    version = [c for c in ("picture",) if c in with_pictures.columns]
    return with_pictures.select("prd_id", _request(settings, parts).alias("request"), *version)
