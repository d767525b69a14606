"""Streams of events: the windows that the batch queries have, kept up while events arrive late and twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows (start, event_type, n, total) by window, of a stream of events (event_id, ts, event_type, value).

    An event that comes again is counted once; events later than `late` after the newest are dropped by the watermark, and
    with them the state of their windows. Batch frames work too: nothing is late there.
    """
    once = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])
    per = once.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return per.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Rows (user_id, start, end, n): a user's events with no more than `gap` between them."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    per = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return per.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
