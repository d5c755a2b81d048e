"""Run pipeline stages from the command line.

    spark-submit --py-files traitlens.zip -m traitlens \\
        --root s3a://bucket/traitlens --csv s3a://bucket/catalog/products.csv \\
        --image-dir s3a://bucket/catalog/ --model my-vlm --chat-url http://model:8000/v1 \\
        --chat-key-env MODEL_KEY --stages catalog_load,trait_requests,trait_inference,trait_extract

The role prompt is read from a file (``--role-prompt-file``); the key, if any,
from the named environment variable on the executors.  Without
``--encoder-model`` the built-in hashing encoder is used.
"""

from __future__ import annotations

import argparse
import logging

from .operators.inference import http_chat_factory, sentence_encoder_factory
from .operators.requests import DEFAULT_ROLE_PROMPT, ChatSettings
from .plans import stages
from .session import build_session


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="traitlens", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--root", required=True, help="folder (shared storage) holding all stage tables")
    p.add_argument("--image-dir", required=True, help="folder holding prd_img/<prd_id>.jpg")
    p.add_argument("--csv", help="scraped catalog CSV (needed by catalog_load)")
    p.add_argument("--stages", default=",".join(stages.STAGES), help="comma-separated subset of " + ",".join(stages.STAGES))
    p.add_argument("--model", default="trait-model")
    p.add_argument("--chat-url", help="OpenAI-compatible base URL for trait_inference")
    p.add_argument("--chat-key-env", help="environment variable holding the endpoint key")
    p.add_argument("--role-prompt-file", help="file with the system role prompt")
    p.add_argument("--temperature", type=float, default=0.0)
    p.add_argument("--chat-tasks", type=int, help="partitions (concurrent tasks) talking to the endpoint")
    p.add_argument("--max-in-flight", type=int, default=1, help="open requests per task")
    p.add_argument("--chat-retries", type=int, default=2, help="retries per failed model call")
    p.add_argument("--encoder-model", help="sentence-embedding model name (optional dependency)")
    p.add_argument("--dim", type=int, default=1024)
    p.add_argument("--hot-key-rows", type=int, help="rows from which scoring splits a product (default: a mean shuffle partition)")
    p.add_argument("--changed-only", action="store_true", help="work only on products that are new since each stage last ran")
    p.add_argument("--database", help="catalog database for bucketed entity tables")
    p.add_argument("--entity-buckets", type=int, help="bucket the entity table by product")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    role = DEFAULT_ROLE_PROMPT
    if args.role_prompt_file:
        with open(args.role_prompt_file, encoding="utf-8") as fh:
            role = fh.read()
    cfg = stages.PipelineConfig(
        root=args.root,
        image_dir=args.image_dir,
        chat=ChatSettings(model=args.model, role_prompt=role, temperature=args.temperature),
        chat_factory=http_chat_factory(args.chat_url, args.chat_key_env) if args.chat_url else None,
        encoder_factory=sentence_encoder_factory(args.encoder_model) if args.encoder_model else None,
        dim=args.dim,
        chat_tasks=args.chat_tasks,
        max_in_flight=args.max_in_flight,
        chat_retries=args.chat_retries,
        hot_key_rows=args.hot_key_rows,
        database=args.database,
        entity_buckets=args.entity_buckets,
    )
    spark = build_session(staging=f"{args.root.rstrip('/')}/_staging")
    stages.run(spark, cfg, stages=[s.strip() for s in args.stages.split(",") if s.strip()], csv_path=args.csv, changed_only=args.changed_only)


if __name__ == "__main__":
    main()
