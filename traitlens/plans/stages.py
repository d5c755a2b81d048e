"""The batch pipeline as stages over a ``TableStore``.

Every stage reads its inputs from tables and writes its outputs (and its
rejects) as tables, so each stage boundary cuts the lineage in shared
storage: a lost executor only recomputes work of the running stage.  Model calls
and encodings are kept by content in logs (``reply_log``, ``vector_log``) that are
published chunk by chunk: a lost task repeats at most its own calls of the chunk
at work, a failed run at most that chunk, and a later run sends only what is new.

Stages, in order:
  catalog_load    CSV -> product_raw (insert-ignore)
  trait_requests  product_raw (+ image files) -> requests_text, requests_image
  trait_inference requests_<side> -> replies_<side>          (model job)
  trait_extract   replies_<side> -> products_trait_<side>
  integrate       product_raw + both trait tables -> products_trait_information
  embed           products_trait_information -> product_embedding (encoder job)
  score           product_embedding -> products_similarity_score_inner
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..constants import DEFAULT_CATEGORY_MAP, DEFAULT_ENCODER_INSTRUCT
from ..operators import catalog, entities, inference, integrate, requests, similarity, traits
from ..operators.quality import validate
from ..schemas import RULES
from ..session import cut_lineage, drop_staging, ensure_checkpoint_dir, staged_paths
from ..sources.catalog_csv import read_catalog_csv
from ..sources.images import Fetch, Stat, fetch_factory, stat_factory
from ..sources.tables import TableStore

log = logging.getLogger("traitlens.stages")

# Tables each stage writes, and the reject partitions it owns (for the run log).
STAGE_OUTPUTS = {
    "catalog_load": (["product_raw"], ["catalog"]),
    "trait_requests": (["requests_text", "requests_image"], ["image_requests", "text_requests"]),
    "trait_inference": (["replies_text", "replies_image"], []),
    "trait_extract": (["products_trait_text", "products_trait_image"], ["traits_text", "traits_image"]),
    "integrate": (["products_trait_information"], ["integrate"]),
    "embed": (["product_embedding"], ["embed"]),
    "score": (["products_similarity_score_inner"], ["score"]),
}
# Tables each stage reads, for runs over what is new in them.
STAGE_INPUTS = {
    "trait_requests": ("product_raw",),
    "trait_inference": ("requests_text", "requests_image"),
    "trait_extract": ("replies_text", "replies_image"),
    "integrate": ("product_raw", "products_trait_text", "products_trait_image"),
    "embed": ("products_trait_information",),
    "score": ("product_embedding",),
}

STAGES = ("catalog_load", "trait_requests", "trait_inference", "trait_extract", "integrate", "embed", "score")
SIDES = ("text", "image")


@dataclass
class PipelineConfig:
    root: str
    image_dir: str
    chat: requests.ChatSettings
    chat_factory: Callable[[], inference.ChatClient] | None = None
    encoder_factory: Callable[[], inference.Encoder] | None = None
    dim: int = 1024
    instruct: str = DEFAULT_ENCODER_INSTRUCT
    category_map: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_CATEGORY_MAP))
    chat_tasks: int | None = None
    max_in_flight: int = 1
    chat_retries: int = 2
    chat_chunk: int = 10_000  # calls whose replies are published together
    encoder_name: str = ""  # of the plugged encoder: another name, other vectors
    encode_chunk: int = 1_000_000
    picture_fetch: Callable[[], Fetch] = fetch_factory
    picture_stat: Callable[[], Stat] = stat_factory
    hot_key_rows: int | None = None  # rows from which scoring splits a product; None: a mean shuffle partition
    database: str | None = None
    entity_buckets: int | None = None


def catalog_load(spark: SparkSession, cfg: PipelineConfig, store: TableStore, csv_path: str) -> None:
    raw = read_catalog_csv(spark, csv_path)
    valid, rejects = catalog.clean_catalog(raw, cfg.image_dir, cfg.category_map, materialize=True)
    store.insert_ignore(valid, "product_raw")
    store.write_rejects(rejects, "catalog", "full")


def trait_requests(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    raw = store.rows_of("product_raw", keys)
    store.write(requests.text_requests(raw, cfg.chat), "requests_text")
    present, missing = requests.attach_pictures(raw, cfg.picture_stat)
    store.write(requests.image_requests(present, cfg.chat), "requests_image")
    store.write_rejects(missing, "image_requests")
    store.write_rejects(requests.unnamed_rejects(raw), "text_requests")


def trait_inference(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    if cfg.chat_factory is None:
        raise ValueError("trait_inference needs a chat_factory (a model endpoint supplied by the user)")
    for side in SIDES:
        replies = inference.resume_chat_job(
            store.rows_of(f"requests_{side}", keys), inference.chat_log(spark, store.path(f"reply_log/{side}")), cfg.chat_factory, cfg.max_in_flight,
            cfg.chat_tasks, retries=cfg.chat_retries, pictures=cfg.picture_fetch, chunk_rows=cfg.chat_chunk,
        )
        store.write(replies, f"replies_{side}")


def trait_extract(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    for side in SIDES:
        name = f"replies_{side}"
        rows = store.read(name) if keys is None else store.new_rows("trait_extract", name)
        valid, rejects = traits.extract_traits(rows, side, materialize=True)
        store.write(valid, f"products_trait_{side}")
        store.write_rejects(rejects, f"traits_{side}")


def integrate_stage(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    names = ("product_raw", "products_trait_text", "products_trait_image")
    valid, rejects = integrate.integrate_traits(*(store.rows_of(n, keys) for n in names), materialize=True)
    store.write(valid, "products_trait_information")
    store.write_rejects(rejects, "integrate")


def embed(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    name = "products_trait_information"
    info = store.read(name) if keys is None else store.new_rows("embed", name)
    docs = entities.entity_documents(info, cfg.instruct)
    if cfg.encoder_factory is not None:
        log = inference.vector_log(spark, store.path("vector_log"))
        encoded = inference.encode_documents(docs, cfg.encoder_factory, "prompt", log=log, encoder_name=cfg.encoder_name, chunk_rows=cfg.encode_chunk)
    else:
        encoded = inference.hashing_encode(docs, cfg.dim, "prd_text")
    valid, rejects = entities.to_entities(encoded, cfg.dim, materialize=True)
    store.write_entities(valid, buckets=cfg.entity_buckets)
    store.write_rejects(rejects, "embed")


def score(spark: SparkSession, cfg: PipelineConfig, store: TableStore, keys: DataFrame | None = None) -> None:
    name = "product_embedding"
    found = store.read(name) if keys is None else store.new_rows("score", name)
    scores, rejects = similarity.similarity_inner(found, hot_key_rows=cfg.hot_key_rows, materialize=True)
    # declared constraints of the score table (the scores are already written once, so this is a cheap read)
    valid, rule_rejects = validate(scores, RULES["products_similarity_score_inner"], "score")
    store.write(valid, "products_similarity_score_inner")
    store.write_rejects(rejects.unionByName(rule_rejects), "score")


def stage_report(store: TableStore, stage: str) -> dict[str, int]:
    """Row counts of a stage's outputs and rejects (Parquet counts read file footers)."""
    tables, reject_parts = STAGE_OUTPUTS[stage]
    report = {t: store.read(t).count() for t in tables if store.exists(t)}
    return report | {f"rejects[{p}]": store.read(f"rejects/{p}").count() for p in reject_parts if store.exists(f"rejects/{p}")}


def _work(store: TableStore, stage: str) -> tuple[bool, DataFrame | None]:
    """``(whether the stage has to do everything, products it has to work on)``: what is new in its inputs since it last ran.

    The model job also asks again for products whose calls have failed.
    """
    anew, keys = store.pending(stage, STAGE_INPUTS[stage])
    if stage == "trait_inference" and not anew:
        for name in (f"rejects/traits_{side}" for side in SIDES):
            if store.exists(name):
                failed = store.read(name).where("rule = 'model_error' and prd_id is not null").select("prd_id")
                keys = failed if keys is None else keys.unionByName(failed)
    if keys is not None:
        keys = cut_lineage(keys.distinct(), "keys")
        keys = None if keys.limit(1).count() == 0 else keys
    return anew, keys


RUNNERS = {
    "trait_requests": trait_requests,
    "trait_inference": trait_inference,
    "trait_extract": trait_extract,
    "integrate": integrate_stage,
    "embed": embed,
    "score": score,
}


def run(spark: SparkSession, cfg: PipelineConfig, stages=STAGES, csv_path: str | None = None, changed_only: bool = False) -> TableStore:
    """Run stages; each publishes its tables together.

    With ``changed_only`` a stage works on the products that are new in its inputs since it last ran and replaces their rows
    only; a stage that has not run, or whose inputs were written anew, does everything, and one without new products nothing.
    """
    ensure_checkpoint_dir(spark, f"{cfg.root.rstrip('/')}/_staging")
    store = TableStore(spark, cfg.root, cfg.database)
    store.create_all()
    for stage in stages:
        staged_before = len(staged_paths())
        if stage == "catalog_load":
            if not csv_path:
                raise ValueError("catalog_load needs csv_path")
            with store.publish(stage):
                catalog_load(spark, cfg, store, csv_path)
        elif stage in RUNNERS:
            anew, keys = _work(store, stage) if changed_only else (True, None)
            if anew or keys is not None:
                with store.publish(stage, STAGE_INPUTS[stage], None if anew else keys):
                    RUNNERS[stage](spark, cfg, store, None if anew else keys)
        else:
            raise ValueError(f"unknown stage {stage!r}")
        # the stage's tables are written: its intermediate staging data is no longer read
        drop_staging(spark, staged_before)
        if log.isEnabledFor(logging.INFO):
            log.info("stage %s done: %s", stage, stage_report(store, stage))
    return store
