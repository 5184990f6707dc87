"""Incremental counterparts on Structured Streaming: scored micro-batches and event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 8) -> DataFrame:
    """A Parquet folder as a stream; new files arrive as micro-batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and summed value per window and kind; rows later than ``late`` are dropped by the watermark of a stream."""
    rows = events.withWatermark(ts, late).groupBy(F.window(ts, size), by).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return rows.select(F.col("window.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user that end after ``gap`` without an event."""
    rows = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), user).agg(F.count("*").alias("n"))
    return rows.select(user, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch and write it under its batch number, so that a repeated batch overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
