"""Streams of metric steps and windowed event aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(events: DataFrame, ts: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per event type and window; works on streams and tables alike."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return events.groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value")).select(F.col("w.start").alias("start"), "event_type", "events", "value")


def sliding(events: DataFrame, ts: str = "ts", width: str = "2 hours", hop: str = "1 hour") -> DataFrame:
    return events.groupBy(F.window(ts, width, hop).alias("w"), "event_type").agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")


def new_steps(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str):
    """Ships each ``(tag, step)`` of arriving JSON files once."""
    rows = spark.readStream.schema(schema).json(folder).withColumn("ts", F.to_timestamp("ts")).withWatermark("ts", "1 day")
    return rows.dropDuplicatesWithinWatermark(["tag", "step"]).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
