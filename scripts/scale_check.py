"""

Usage: python scripts/scale_check.py SCRATCH_DIR [n_vectors] [dim]

Writes generated unit-free random vectors to SCRATCH_DIR/embeddings.parquet
(the same layout as the test table), then times ``similarity_scores`` with the
Arrow and the native kernel, and the salted vs unsalted plan with a third of
all entities re-keyed onto one product (AQE skew-join off to isolate salting).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def generate(path: str, n: int, dim: int) -> None:
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    m = np.random.default_rng(0).normal(size=(n, dim)).astype(np.float32)
    offsets = pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32))
    emb = pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))
    ids = np.arange(n)
    pq.write_table(
        pa.table({"vec_id": ids, "embedding": emb, "label": (ids % 10).astype(np.int32)}),
        os.path.join(path, "embeddings.parquet"),
        row_group_size=4096,
    )


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 2)


def main() -> None:
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 60_000
    dim = int(sys.argv[3]) if len(sys.argv) > 3 else 1024
    os.makedirs(scratch, exist_ok=True)
    if not os.path.exists(os.path.join(scratch, "embeddings.parquet")):
        generate(scratch, n, dim)

    from pyspark.sql import functions as F

    import traitlens.functions.vectors as V
    from traitlens.operators import similarity
    from traitlens.plans import fixtures as fx
    from traitlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={"spark.driver.memory": "16g"})
    ent = fx.entities_from_embeddings(spark.read.parquet(os.path.join(scratch, "embeddings.parquet")))
    for impl in ("arrow", "native", "arrow", "native"):
        V.DEFAULT_IMPL = impl
        print("kernel", impl, timed(similarity.similarity_inner(ent)[0]), flush=True)
    V.DEFAULT_IMPL = "arrow"
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    hot = ent.withColumn("prd_id", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("prd_id")))
    for label, rows in (("unsalted", None), ("salted", max(n // 30, 1)), ("unsalted", None), ("salted", max(n // 30, 1))):
        print("skew", label, timed(similarity.similarity_inner(hot, hot_key_rows=rows)[0]), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
