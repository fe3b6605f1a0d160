"""Beyond the reference: counts of late-arriving events per window with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, ddl: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, event_type, n, total): events later than the watermark are dropped by it, state is bounded by it."""
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(s, "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
