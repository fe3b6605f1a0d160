"""Trading calendars as tables: one row per trading day with its index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.asof import asof


def day_axis(dates: DataFrame, column: str = "date") -> DataFrame:
    """(date, day_index from 1). The window has one row per trading day, which a century bounds."""
    days = dates.select(F.col(column).alias("date")).where("date IS NOT NULL").distinct()
    return days.withColumn("day_index", F.row_number().over(Window.orderBy("date")).cast("long"))


def weekdays(spark: SparkSession, start: str, end: str, holidays: list[str] | None = None) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("date")).where(F.weekday("date") < 5)
    return days.where(~F.col("date").isin([F.to_date(F.lit(h)) for h in holidays])) if holidays else days


def neighbours(dates: DataFrame, axis: DataFrame, column: str = "date", offset: int = 1) -> DataFrame:
    """Adds is_open, previous and next: the trading days `offset` before and after each date, NULL beyond the calendar.

    With offset 0, previous is the first trading day from the date on and next the last one up to it.
    """
    if offset < 0:
        raise ValueError("offset must not be negative")
    days = axis.select(F.col("date").alias("_day"), "day_index")
    # how many trading days lie before the date, and up to it
    before = asof(dates, days, [], column, "_day", ["day_index"], allow_equal=False).withColumnRenamed("day_index", "_before").drop("matched__day")
    both = asof(before, days, [], column, "_day", ["day_index"]).withColumnRenamed("day_index", "_upto").drop("matched__day")
    both = both.withColumn("_before", F.coalesce("_before", F.lit(0))).withColumn("_upto", F.coalesce("_upto", F.lit(0)))
    at = lambda name, key: days.select(F.col("day_index").alias(key), F.col("_day").alias(name))
    both = both.withColumn("_p", F.col("_before") + 1 - offset).withColumn("_n", F.col("_upto") + offset)
    out = both.join(F.broadcast(at("previous", "_p")), "_p", "left").join(F.broadcast(at("next", "_n")), "_n", "left")
    return out.withColumn("is_open", F.col("_upto") > F.col("_before")).drop("_before", "_upto", "_p", "_n")


def month_ends(axis: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Last trading day of each month in the range; the range's last day counts even within a month."""
    days = axis
    if start:
        days = days.where(F.col("date") >= F.to_date(F.lit(start)))
    if end:
        days = days.where(F.col("date") <= F.to_date(F.lit(end)))
    return days.groupBy(F.trunc("date", "month").alias("month")).agg(F.max("date").alias("date"), F.max("day_index").alias("day_index")).drop("month")


def shift(days: DataFrame, axis: DataFrame, offset: int, name: str) -> DataFrame:
    """Adds the trading day `offset` days later (negative: earlier). Beyond an edge there is none, and the row goes."""
    to = axis.select((F.col("day_index") - offset).alias("day_index"), F.col("date").alias(name))
    return days.join(F.broadcast(to), "day_index")


def ticker_reuse(rows: DataFrame, gap: int = 250) -> DataFrame:
    """Consecutive rows of a ticker more than `gap` trading days apart."""
    w = Window.partitionBy("ticker").orderBy("date")
    axis = day_axis(rows)
    seen = rows.join(F.broadcast(axis), "date")
    seen = seen.select("ticker", F.lag("date").over(w).alias("previous_date"), F.col("date").alias("next_date"), F.lag("name").over(w).alias("previous_name"), F.col("name").alias("next_name"), (F.col("day_index") - F.lag("day_index").over(w)).alias("gap_days"))
    return seen.where(F.col("gap_days") > gap).withColumn("name_changed", F.coalesce(F.col("previous_name") != F.col("next_name"), F.lit(False)))
