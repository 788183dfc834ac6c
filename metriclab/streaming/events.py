"""Windowed counts over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days", time: str = "ts") -> DataFrame:
    """(window_start, event_type, n, total): the same plan for a stream and for a table.

    On a stream, state older than ``late`` is dropped and its windows are final.
    """
    events = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("_t", late)
    found = events.groupBy(F.window("_t", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
