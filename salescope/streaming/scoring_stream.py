"""Structured Streaming front end for order scoring.

New order files (JSON lines) arriving in a folder are scored with the same
stateless plan as the batch path; predictions and rejects are appended to
two sinks through ``foreachBatch`` (idempotent per batch id when the sink
paths are written by batch id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salescope.plans.scoring import ORDER_JSON_SCHEMA, score_orders
from salescope.sources.sinks import Bundle


def order_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(ORDER_JSON_SCHEMA)
                 .option("maxFilesPerTrigger", max_files_per_trigger).json(folder))


def start_scoring(spark: SparkSession, folder: str, bundle: Bundle, out: str, checkpoint: str,
                  trigger_once: bool = False):
    """Start the stream; returns the StreamingQuery."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored, rejected = score_orders(batch, bundle)
        scored.write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")

    writer = (order_stream(spark, folder).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
