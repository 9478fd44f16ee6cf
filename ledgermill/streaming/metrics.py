"""Windowed metric summaries over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.operators.metrics import combined_summary, partial_summary


def event_points(events: DataFrame) -> DataFrame:
    """Events as metric points: the type names the metric."""
    return events.select(
        F.col("event_type").alias("name"),
        "value",
        F.lit("count").alias("unit"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def run_summary(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str, width: str = "1 hour") -> StreamingQuery:
    """Summarise all files that are there now, then stop.

    Every micro-batch writes partial summaries of the windows that its events fall in into its own folder, and
    ``current_windows`` adds them up. So no event comes too late, no state is held, and a batch that is
    replayed after a failure replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_summary(event_points(batch), width).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_windows(spark: SparkSession, target: str) -> DataFrame:
    """The summary of every window and metric over all events that have come."""
    return combined_summary(spark.read.option("basePath", target).parquet(target))
