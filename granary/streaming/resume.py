"""Resumable runs: what a batch pass left undone, picked up as files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def resume(spark: SparkSession, source: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], files_per_batch: int = 1000) -> int:
    """Handle every file of a Parquet folder that no earlier call has handled; returns the number of batches.

    The checkpoint remembers the files, so a call after a crash starts with
    the batch that failed; handle must be idempotent for its batch number.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(q.recentProgress)
