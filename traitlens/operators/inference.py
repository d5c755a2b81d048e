"""Batch model jobs: chat requests -> replies, documents -> vectors.

The models themselves are plugged in by the user as factories; nothing here
ships a model or an endpoint.  A factory is called once per task (not once
per row), then reused for every Arrow batch of the partition.

* ``resume_chat_job``: ``(prd_id, request)`` -> ``(prd_id, status, content, error)`` through a ``ResultLog``: equal requests
  are sent once, replies are published chunk by chunk, and a later run sends only what has no successful reply yet.
* ``run_chat_job``: the same without a log, one lazy frame.  Model output is not reproducible and Spark may recompute it,
  so write its result before reading it twice.
* ``encode_documents``: adds ``embedding array<float>``.  Each distinct text is encoded once, however many documents hold
  it; with a log only texts that no earlier run has encoded.
* ``hashing_encode``: a model-free baseline encoder done entirely in the JVM
  (feature hashing of word tokens, L2-normalised).

A failing call becomes ``status = false`` with the message, never a failed task.  Pictures are bound late: a request holds
the picture's path, and the task that sends it reads the bytes.
"""

from __future__ import annotations

import base64
import json
import os
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DATA_URL_PREFIX
from ..schemas import REPLIES
from ..session import cut_lineage
from ..sources.images import Fetch, fetch_factory
from .resume import DIGEST, ResultLog, digest
from .skew import split_join

ChatClient = Callable[[str], str]
Encoder = Callable[[list[str]], "object"]

CHAT_LOG = T.StructType(
    [
        T.StructField(DIGEST, T.StringType(), False),
        T.StructField("status", T.BooleanType(), False),
        T.StructField("content", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
VECTOR_LOG = T.StructType([T.StructField(DIGEST, T.StringType(), False), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def chat_log(spark, path: str) -> ResultLog:
    """A log of replies; failed calls are asked again by the next run."""
    return ResultLog(spark, path, CHAT_LOG, finished="status")


def vector_log(spark, path: str) -> ResultLog:
    """A log of vectors by text; texts that could not be encoded are tried again by the next run."""
    return ResultLog(spark, path, VECTOR_LOG, finished="embedding is not null")


def bind_pictures(request: str, fetch: Fetch) -> str:
    """The request with the bytes of its pictures in place of their paths."""
    if '"image_url"' not in request:
        return request
    body = json.loads(request)
    for message in body["messages"]:
        for part in message["content"]:
            url = (part.get("image_url") or {}).get("url") if part.get("type") == "image_url" else None
            if url is not None and not url.startswith("data:"):
                part["image_url"]["url"] = DATA_URL_PREFIX + base64.b64encode(fetch(url)).decode("ascii")
    return json.dumps(body, ensure_ascii=False, separators=(",", ":"))


def bound_requests(requests_df: DataFrame, pictures: Callable[[], Fetch] = fetch_factory, tasks: int | None = None) -> DataFrame:
    """``(prd_id, request)`` as the model job sends them, pictures included.

    A request without its picture is small, so many lie in one partition; ``tasks`` deals them over so many.
    """

    def job(batches: Iterator) -> Iterator:
        fetch = pictures()
        for pdf in batches:
            yield pdf.assign(request=[bind_pictures(r, fetch) for r in pdf["request"]])

    return _with_tasks(requests_df.select("prd_id", "request"), tasks).mapInPandas(job, "prd_id string, request string")


def _send(
    requests_df: DataFrame, key: str, client_factory, max_in_flight: int, tasks: int | None, retries: int, backoff_seconds: float,
    pictures: Callable[[], Fetch], schema: T.StructType,
) -> DataFrame:
    def job(batches: Iterator) -> Iterator:
        import time

        import pandas as pd

        client, fetch = client_factory(), pictures()

        def call(req: str):
            for attempt in range(retries + 1):
                try:
                    return True, client(bind_pictures(req, fetch)), None
                except Exception as exc:  # one bad row is one reject
                    error = f"{type(exc).__name__}: {exc}"
                    if attempt < retries:
                        time.sleep(backoff_seconds * (2**attempt))
            return False, None, error

        pool = ThreadPoolExecutor(max_workers=max_in_flight) if max_in_flight > 1 else None
        try:
            for pdf in batches:
                reqs = pdf["request"].tolist()
                results = list(pool.map(call, reqs)) if pool else [call(r) for r in reqs]
                status, content, error = zip(*results) if results else ((), (), ())
                yield pd.DataFrame({key: pdf[key], "status": list(status), "content": list(content), "error": list(error)})
        finally:
            if pool:
                pool.shutdown()

    return _with_tasks(requests_df.select(key, "request"), tasks).mapInPandas(job, schema)


def run_chat_job(
    requests_df: DataFrame,
    client_factory: Callable[[], ChatClient],
    max_in_flight: int = 1,
    tasks: int | None = None,
    retries: int = 0,
    backoff_seconds: float = 1.0,
    pictures: Callable[[], Fetch] = fetch_factory,
) -> DataFrame:
    """Send every request to the model; capture each reply or error per row.

    ``tasks`` bounds how many partitions (hence concurrent tasks) talk to the
    endpoint; ``max_in_flight`` is the number of requests one task keeps open.
    A failed call is retried up to ``retries`` times with exponential backoff
    before it becomes a reject row.
    """
    return _send(requests_df, "prd_id", client_factory, max_in_flight, tasks, retries, backoff_seconds, pictures, REPLIES)


def resume_chat_job(
    requests_df: DataFrame,
    log: ResultLog,
    client_factory: Callable[[], ChatClient],
    max_in_flight: int = 1,
    tasks: int | None = None,
    retries: int = 0,
    backoff_seconds: float = 1.0,
    pictures: Callable[[], Fetch] = fetch_factory,
    chunk_rows: int = 10_000,
) -> DataFrame:
    """``run_chat_job`` through a log of replies (``chat_log``); returns the replies of all rows of ``requests_df``.

    A request is named by its text and, where the frame has a column ``picture`` (the picture file's version), by that.
    """
    version = [F.col("picture")] if "picture" in requests_df.columns else []
    named = requests_df.select("prd_id", "request", digest(F.col("request"), *version).alias(DIGEST))

    def send(chunk: DataFrame) -> DataFrame:
        return _send(chunk, DIGEST, client_factory, max_in_flight, tasks, retries, backoff_seconds, pictures, CHAT_LOG)

    log.complete(named.select(DIGEST, "request"), send, chunk_rows)
    return split_join(named.select("prd_id", DIGEST), log.read(named), DIGEST, ["prd_id"]).select("prd_id", "status", "content", "error")


def _with_tasks(df: DataFrame, tasks: int | None) -> DataFrame:
    """Exactly ``tasks`` partitions, hence at most so many concurrent tasks (a shuffle of the requests)."""
    return df.repartition(tasks) if tasks else df


def encode_documents(
    docs: DataFrame,
    encoder_factory: Callable[[], Encoder],
    text_col: str = "prompt",
    batch_size: int = 1000,
    log: ResultLog | None = None,
    encoder_name: str = "",
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``embedding`` (array<float>) computed by the plugged-in encoder, once per distinct text.

    The encoder receives lists of at most ``batch_size`` strings (the original
    encodes 1,000 at a time) and returns an (n, dim) array-like.  If a batch
    fails, its rows are encoded one by one so only the failing texts get a null
    embedding (rejected later by the not-null rule).

    With a ``log`` (``vector_log``) vectors are kept by text and ``encoder_name``, and only new texts are encoded; without
    one they are written to the staging folder.  Vectors come back to the documents by digest; the documents of a text that
    very many share are dealt over tasks.  A null text is encoded as ''.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.withColumn(DIGEST, digest(text, F.lit(encoder_name)))
    asked = named.select(DIGEST, text.alias("text"))
    if log is not None:
        log.complete(asked, lambda chunk: _vectors(chunk, encoder_factory, batch_size), chunk_rows)
        vectors = log.read(asked)
    else:
        distinct = asked.groupBy(DIGEST).agg(F.first("text").alias("text"))
        vectors = cut_lineage(_vectors(distinct, encoder_factory, batch_size), "vectors")
    return split_join(named, vectors, DIGEST, [c for c in docs.columns if c != text_col] or [text_col]).select(*docs.columns, "embedding")


def _vectors(texts: DataFrame, encoder_factory: Callable[[], Encoder], batch_size: int) -> DataFrame:
    """``(digest, text)`` -> ``(digest, embedding)``."""

    def job(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        encoder = encoder_factory()

        def one(text):
            try:
                return np.asarray(encoder([text]), dtype=np.float32)[0].tolist()
            except Exception:
                return None

        def encode(texts):
            try:
                return [v.tolist() for v in np.asarray(encoder(texts), dtype=np.float32)]
            except Exception:
                return [one(t) for t in texts]

        for pdf in batches:
            found = pdf["text"].tolist()
            vecs = []
            for start in range(0, len(found), batch_size):
                vecs.extend(encode(found[start : start + batch_size]))
            yield pd.DataFrame({DIGEST: pdf[DIGEST], "embedding": vecs})

    return texts.select(DIGEST, "text").mapInPandas(job, VECTOR_LOG)


def hashing_encode(docs: DataFrame, dim: int, text_col: str = "prd_text") -> DataFrame:
    """Model-free baseline: hashed bag of lower-cased word tokens, unit length.

    Runs as Spark ML feature transformers (JVM), so no Python worker is used.
    Documents without any token get a zero vector (cosine undefined -> null).
    """
    from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"\W+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim)
    unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0)
    out = unit.transform(tf.transform(tok.transform(docs)))
    return out.withColumn("embedding", vector_to_array("_unit", dtype="float32")).drop("_tokens", "_tf", "_unit")


# --- adapters for real services (optional dependencies) ---------------------------

def http_chat_factory(base_url: str, api_key_env: str | None = None, timeout: float = 120.0):
    """Factory for an OpenAI-compatible ``/chat/completions`` endpoint.

    The key is read on the executor from the named environment variable so it
    never enters the plan or the repository.
    """

    def factory() -> ChatClient:
        key = os.environ.get(api_key_env, "") if api_key_env else ""
        url = base_url.rstrip("/") + "/chat/completions"

        def client(request_json: str) -> str:
            req = urllib.request.Request(url, data=request_json.encode("utf-8"), method="POST")
            req.add_header("Content-Type", "application/json")
            if key:
                req.add_header("Authorization", f"Bearer {key}")
            with urllib.request.urlopen(req, timeout=timeout) as resp:
                body = json.loads(resp.read().decode("utf-8"))
            return body["choices"][0]["message"]["content"]

        return client

    return factory


def sentence_encoder_factory(model_name: str, **kwargs):
    """Factory for a sentence-embedding model, if that library is installed on executors."""

    def factory() -> Encoder:
        try:
            from sentence_transformers import SentenceTransformer
        except ImportError as exc:  # pragma: no cover - optional dependency
            raise RuntimeError("sentence-transformers is not installed on this executor") from exc
        model = SentenceTransformer(model_name, **kwargs)
        return lambda texts: model.encode(texts)

    return factory
