"""Routed scoring (M4, M5) as a Structured Streaming job.

The reference scores finite batches; here the same scorer runs per
micro-batch through ``foreachBatch``: each batch is a bounded DataFrame, so
the feature build (including the substring-lookup aggregate, which a plain
streaming projection could not run) and both models apply unchanged.  The
sink is an idempotent per-batch parquet append keyed by ``batch_id``, and
the checkpoint lives in the shared folder, so a restarted query resumes.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.plans.models import route_and_score


def score_stream(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint_dir: str,
                 config: dict, contexts: dict, new_model, returning_model, threshold: float = 0.5,
                 max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, drain) a scoring stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        scores = route_and_score(batch, config, contexts, new_model, returning_model, threshold)
        (scores.withColumn("batch_id", F.lit(batch_id))
               .write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}")))

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
