"""Streaming.

The source pipeline is batch-only (no stream sources, watermarks or state), so no
streaming operator is part of the inventory.  ``stage_stream`` lets a stage
function that maps DataFrame -> DataFrame run incrementally over new parquet files
with Structured Streaming's ``foreachBatch``, which is how the batch stages would be fed
continuously.  Each batch overwrites a folder named by its id, so a batch that is run
again after a failure replaces its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def stage_stream(spark: SparkSession, src: str, schema, fn: Callable[[DataFrame], DataFrame], sink: str,
                 checkpoint: str, trigger_once: bool = True):
    """Run ``fn`` on each micro-batch of new files under ``src`` and write the
    result to ``sink/batch_id=N``.  Returns the started query."""
    stream = spark.readStream.schema(schema).parquet(src)

    def _write(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
