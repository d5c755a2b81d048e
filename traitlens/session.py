"""SparkSession helpers.

The library never assumes it owns the session: every operator takes a
DataFrame and returns a DataFrame.  These helpers exist for the CLI-style
entry points (bench, tests, the stage runner) that must build one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the pipeline is designed around.  AQE re-plans joins
# and coalesces small shuffle partitions at runtime; the skew-join rule splits
# oversized join partitions even when that costs one extra (small) exchange.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_sql_conf(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict[str, str]:
    """Partition sizing for a cluster run, from the size of the largest shuffle.

    The initial shuffle partition count puts about ``partition_bytes`` in each
    post-shuffle partition (a dim-1024 vector row is ~4 KB, so 256 MB is ~65k
    rows per task, well inside executor memory); AQE then coalesces small
    partitions and splits skewed ones.  Scan splits use the same target.
    Example: a 100 TB entity shuffle -> 409,600 partitions.
    """
    parts = max(min_partitions, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "traitlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    staging: str | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the recommended settings.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_SQL_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if staging or _is_local(spark.sparkContext.master):
        ensure_checkpoint_dir(spark, staging)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  When nothing is configured, ``fallback`` (a folder on shared storage, such as the
    pipeline's root) is registered; without one, a private scratch folder in local mode only.  On a cluster that is an
    error: executors do not see each other's local folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback is None:
        if not _is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        fallback = tempfile.mkdtemp(prefix="traitlens-ckpt-")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def _is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/traitlens-staging/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str = "stage", compression: str | None = None):
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    ``compression`` names a Parquet codec other than the session's, for tables where size matters more than speed.

    The plan is computed exactly once (an eager RDD checkpoint of an unpersisted
    frame computes it twice), the files survive executor loss, and later
    consumers of the returned frame re-read files instead of recomputing.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    track_staging(path)
    return spark.read.parquet(path)


def track_staging(path: str) -> str:
    """Note a staging folder written by other means, for ``drop_staging``."""
    _STAGED.append(path)
    return path


# Staging folders written by ``cut_lineage`` in this driver process, in order.
_STAGED: list[str] = []


def staged_paths() -> list[str]:
    return list(_STAGED)


def drop_staging(spark: SparkSession, since: int = 0) -> int:
    """Delete the staging folders created after position ``since`` of ``staged_paths()``.

    Call it only once nothing reads them any more (the stage runner does so
    after a stage's tables are written).  Returns how many were removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while len(_STAGED) > since:
        p = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        if p.getFileSystem(conf).delete(p, True):
            removed += 1
    return removed
