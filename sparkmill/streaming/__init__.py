"""Event streams: tumbling counts with a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import table


def tumbling_counts(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Per window and event type: n and the sum of value. Works on a batch or a stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("ts", late)
    by = timed.groupBy(F.window("ts", window).alias("w"), "event_type")
    return by.agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day, event type, n and value (to two places) of all events."""
    days = tumbling_counts(table(spark, sf_dir, "events"))
    return days.select(F.to_date("start").alias("day"), "event_type", "n", F.round("value", 2).alias("value"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"tumbling_counts": daily_counts}


def oracle_sql() -> dict[str, str]:
    return {"tumbling_counts": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2"}
