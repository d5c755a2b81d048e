"""Incremental trait extraction: model replies arriving as files.

When replies land continuously (one file per finished model batch), the
trait-extraction stage runs as a Structured Streaming query over the reply
folder.  Parsing is stateless, so each micro-batch is parsed independently;
valid trait rows and rejects are written per micro-batch into a folder named
after the batch id with overwrite, so a re-executed batch replaces its own
output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.traits import extract_traits
from ..schemas import REPLIES
from ..session import ensure_checkpoint_dir


def stream_trait_extract(
    spark: SparkSession,
    replies_dir: str,
    side: str,
    out_dir: str,
    rejects_dir: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the streaming parse of ``replies_dir`` (Parquet files of REPLIES rows)."""
    reader = spark.readStream.schema(REPLIES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(replies_dir)
    if checkpoint_location is None:
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/traitlens-streams/traits_{side}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, rejects = extract_traits(batch, side)
            valid.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
            rejects.write.mode("overwrite").parquet(f"{rejects_dir}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
