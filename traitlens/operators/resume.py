"""Results of expensive calls, kept by content and published chunk by chunk.

A call is named by the digest of what is sent.  ``ResultLog.complete`` asks for what the log does not hold yet: distinct
digests, anti-joined with the finished ones, written in chunks of about ``chunk_rows`` calls, one Spark job a chunk.  A
chunk's results become visible when its job commits.  So

* equal requests are sent once, however many products share them;
* a job that dies repeats at most the calls of the chunk it was in; a lost task repeats at most its part of that chunk;
* a later run sends only what is new or has failed before.

The log is ``<path>/chunk=<run>-<number>/*.parquet`` with the columns of ``schema``, one of them ``digest``.  A row stands by
itself, so what an unfinished commit leaves behind is used, not repeated; of several rows of a digest one finished one is
read.  Digests are 256 bits of SHA-2: unlike contents do not meet.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, staging_path, track_staging

DIGEST = "digest"


def digest(*parts: Column) -> Column:
    """Name of a content: SHA-256 of its parts, each with its length, so that parts cannot run into each other."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat(*(F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text)), 256)


class ResultLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, finished: str = "true"):
        """``finished`` is an SQL condition on a row: only such rows are never asked for again."""
        if DIGEST not in schema.fieldNames():
            raise ValueError(f"a result log needs a column {DIGEST!r}")
        self.spark, self.path, self.schema, self.finished = spark, path.rstrip("/"), schema, finished

    def _exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, asked: DataFrame | None = None) -> DataFrame:
        """One row a digest: a finished one if there is any, else that of the latest run.

        With ``asked(digest)`` only of those, and only from the chunks that hold one of them: which, the digest columns tell.
        """
        if not self._exists():
            return self.spark.createDataFrame([], self.schema)
        names = self.schema.fieldNames()
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("chunk", T.StringType())])).parquet(self.path)
        if asked is not None:
            wanted = asked.select(DIGEST).distinct()
            chunks = [r["chunk"] for r in rows.select(DIGEST, "chunk").join(wanted, DIGEST, "left_semi").select("chunk").distinct().collect()]
            rows = rows.where(F.col("chunk").isin(chunks)).join(wanted, DIGEST, "left_semi")
        order = F.struct(F.expr(self.finished).alias("done"), F.col("chunk"))
        others = [n for n in names if n != DIGEST]
        best = rows.groupBy(DIGEST).agg(F.max_by(F.struct(*others), order).alias("r"))
        return best.select(*(F.col(DIGEST) if n == DIGEST else F.col(f"r.{n}").alias(n) for n in names))

    def complete(self, asked: DataFrame, compute: Callable[[DataFrame], DataFrame], chunk_rows: int = 10_000) -> int:
        """Run ``compute`` on the rows of ``asked(digest, ...)`` that are not finished; returns how many there were.

        ``compute`` maps rows to rows of the log's schema.  Rows with equal digests are equal: one of them is asked.
        """
        done = self.read().where(self.finished).select(DIGEST)
        others = [c for c in asked.columns if c != DIGEST]
        one = asked.groupBy(DIGEST).agg(F.first(F.struct(*others)).alias("r")).select(DIGEST, "r.*")
        todo = cut_lineage(one.join(done, DIGEST, "left_anti"), "todo")
        rows = todo.count()
        chunks = -(-rows // chunk_rows)
        if not chunks:
            return 0
        # Written by chunk, so that each job reads its own rows only.
        folder = track_staging(staging_path(self.spark, "chunks"))
        number = F.pmod(F.xxhash64(DIGEST), F.lit(chunks)).alias("number")
        todo.select("*", number).repartition("number").write.partitionBy("number").parquet(folder)
        numbered = self.spark.read.schema(T.StructType([*todo.schema.fields, T.StructField("number", T.LongType())])).parquet(folder)
        run = f"{time.time_ns() // 1_000_000:015d}"
        for k in range(chunks):
            part = compute(numbered.where(F.col("number") == k).drop("number"))
            part.select(*self.schema.fieldNames()).write.mode("errorifexists").parquet(f"{self.path}/chunk={run}-{k:07d}")
        return rows
