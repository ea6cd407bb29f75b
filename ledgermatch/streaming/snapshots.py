"""Monthly snapshots as a stream: each new file of a landing folder runs through the batch cascade."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landing(spark: SparkSession, folder: str, schema: str, files_a_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def run_batches(rows: DataFrame, cascade: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's matches under its own id, so that a batch that runs again replaces what it wrote."""

    def batch(frame: DataFrame, batch_id: int) -> None:
        cascade(frame).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def coverage_by_window(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and their sum per type and window, with a bound on late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
