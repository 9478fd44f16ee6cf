"""Summaries of metric points (name, value, unit, timestamp, labels, metadata)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def select_metrics(
    points: DataFrame, name: str | None = None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    if name is not None:
        points = points.filter(F.col("name") == name)
    if start is not None:
        points = points.filter(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        points = points.filter(F.col("timestamp") <= F.lit(end).cast("timestamp_ntz"))
    return points


def summary_columns(order: Column) -> list[Column]:
    """count, min, max, avg, first and latest; ``order`` breaks ties of the timestamp."""
    return [
        F.count("*").alias("count"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.min_by("value", order).alias("first"),
        F.max_by("value", order).alias("latest"),
    ]


def metric_summary(points: DataFrame, order: Column | None = None) -> DataFrame:
    order = F.col("timestamp") if order is None else order
    return points.groupBy("name").agg(*summary_columns(order))


def windowed_summary(points: DataFrame, width: str) -> DataFrame:
    """The summary per name and tumbling window; works on a stream and on a table."""
    grouped = points.groupBy(F.window("timestamp", width).alias("w"), "name").agg(
        *summary_columns(F.struct("timestamp", "value"))
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *grouped.columns[1:]
    )


WINDOW = ("window_start", "window_end", "name")


def partial_summary(points: DataFrame, width: str) -> DataFrame:
    """What a share of the points adds to the summary of their windows; ``combined_summary`` adds shares up."""
    at = F.struct("timestamp", "value")
    grouped = points.groupBy(F.window("timestamp", width).alias("w"), "name").agg(
        F.count("*").alias("count"),
        F.count("value").alias("values"),
        F.sum("value").alias("sum"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.min(at).alias("first"),
        F.max(at).alias("latest"),
    )
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *grouped.columns[1:])


def combined_summary(partials: DataFrame) -> DataFrame:
    """``windowed_summary`` of all points, from the partial summaries of any shares of them, in any order."""
    return partials.groupBy(*WINDOW).agg(
        F.sum("count").alias("count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        (F.sum("sum") / F.nullif(F.sum("values"), F.lit(0))).alias("avg"),
        F.min("first")["value"].alias("first"),
        F.max("latest")["value"].alias("latest"),
    )


def quality_points(results: DataFrame, at: datetime) -> DataFrame:
    """Quality results as metric points."""
    labels = F.create_map(
        F.lit("table"), F.col("table"), F.lit("check"), F.col("check"), F.lit("passed"), F.col("passed").cast("string")
    )

    def point(name: str, value: str, unit: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.col(value).cast("double").alias("value"), F.lit(unit).alias("unit"))

    values = F.array(
        point("data_quality_score", "score", "%"),
        point("data_quality_rows_checked", "checked", "rows"),
        point("data_quality_failed_rows", "failed", "rows"),
    )
    return (
        results.select(labels.alias("labels"), F.inline(values))
        .filter((F.col("name") != "data_quality_failed_rows") | (F.col("value") > 0))
        .select(
            "name",
            "value",
            "unit",
            F.lit(at).cast("timestamp_ntz").alias("timestamp"),
            "labels",
            F.lit(None).cast("map<string,string>").alias("metadata"),
        )
    )


def measured(df: DataFrame, load: Callable[[DataFrame], None], table: str, at: datetime) -> DataFrame:
    """Run ``load`` on ``df`` and return its rows, milliseconds and rows per second as metric points.

    Rows are counted by the load itself, as they pass; nothing is read twice.
    """
    seen, started = Observation(), time.perf_counter()
    load(df.observe(seen, F.count("*").alias("rows")))
    duration = (time.perf_counter() - started) * 1000
    return load_points(df.sparkSession, [(table, seen.get["rows"], duration)], at)


def load_points(spark: SparkSession, loads: Sequence[tuple[str, int, float]], at: datetime) -> DataFrame:
    """Metric points of loads given as (table, rows, milliseconds)."""
    frame = spark.createDataFrame([(t, float(n), float(ms)) for t, n, ms in loads], "table string, rows double, ms double")

    def point(name: str, value: Column, unit: str) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"), F.lit(unit).alias("unit"))

    values = F.array(
        point("data_processing_rows", F.col("rows"), "rows"),
        point("data_processing_duration_ms", F.col("ms"), "ms"),
        point("data_processing_throughput", throughput(F.col("rows"), F.col("ms")), "rows/sec"),
    )
    labels = F.create_map(F.lit("table"), F.col("table")).alias("labels")
    return frame.select(labels, F.inline(values)).select(
        "name", "value", "unit", F.lit(at).cast("timestamp_ntz").alias("timestamp"), "labels", F.lit(None).cast("map<string,string>").alias("metadata")
    )


def stream_points(query: StreamingQuery, table: str, at: datetime) -> DataFrame:
    """Metric points of a stream's micro-batches that had rows, from its own progress reports."""
    loads = [(table, p.numInputRows, float(p.durationMs.get("triggerExecution", 0))) for p in query.recentProgress if p.numInputRows]
    return load_points(SparkSession.active(), loads, at)


def throughput(rows: Column, milliseconds: Column) -> Column:
    """Rows per second; 0 without a duration."""
    return F.when(milliseconds > 0, rows / (milliseconds / 1000)).otherwise(F.lit(0.0))
