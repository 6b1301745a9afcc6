"""Beyond the batch metrics: weekly counts over a stream of events, with late ones up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weekly_counts(events: DataFrame, late: str = "7 days") -> DataFrame:
    """(week_start, event_type, n) over a batch or a stream with a timestamp ``ts``."""
    week = F.window("ts", "7 days", startTime="4 days").alias("w")  # weeks from Monday: 1 January 1970 was a Thursday
    return events.withWatermark("ts", late).groupBy(week, "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("date").cast("string").alias("week_start"), "event_type", "n")
