"""Hot-key handling for joins of a large per-key table with a one-row-per-key table.

Any key may hold a large share of all rows (a degenerate product id, a bulk import under one id).  ``split_join`` divides
such keys inside the plan, on any session:

* rows per key are counted over the key column alone, combined map-side;
* a key is hot when it holds at least the mean rows of a shuffle partition.  With P shuffle partitions at most P keys can
  be hot, so their table is broadcast with a proven bound, whatever the data;
* rows of other keys take a plain equi-join, which keeps a bucketed table's layout; rows of hot keys are dealt over salts
  of an eighth of a partition each and meet one copy of their partner per salt.  All copies together are at most 9 P rows;
* without hot keys adaptive execution finds the broadcast table empty and drops the second branch before it is scanned.

Every row of the large side meets its partner exactly once.  Salts are hashes of the row's own values, so a retried task
deals its rows the same way.  No job runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
N_SALT = "_n_salt"
PER_PARTITION = 8  # salts that a mean partition's rows are dealt over


ROWS = "_rows"


def hot_keys(df: DataFrame, key: str, min_rows: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Keys that hold at least a mean shuffle partition's rows (or ``min_rows``), with the salts that each needs."""
    if counts is None:
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(ROWS))
    if min_rows is not None:
        share = F.lit(min_rows)
    else:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = counts.agg(F.sum(ROWS)).scalar() / F.lit(parts)
    return counts.where(F.col(ROWS) >= share).select(key, F.ceil(F.col(ROWS) * PER_PARTITION / share).alias(N_SALT))


def split_join(
    big: DataFrame, small: DataFrame, key: str, salt_by: list[str], min_rows: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Inner equi-join of ``big`` with ``small`` (unique on ``key``); see the module's notes.

    ``counts`` (``key``, ``ROWS``) are the rows of ``big`` per key of ``small``, where they are known already.
    ``min_rows`` replaces the mean partition as the size from which a key is split; it must keep the hot keys few.
    """
    hot = F.broadcast(hot_keys(big, key, min_rows, counts))
    plain = big.join(hot.select(key), key, "left_anti").join(small, key)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.col(N_SALT))
    dealt = big.join(hot, key).withColumn(SALT, salt).drop(N_SALT)
    copies = small.join(hot, key).withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.col(N_SALT) - 1))).drop(N_SALT)
    return plain.unionByName(dealt.join(copies, [key, SALT]).drop(SALT))
