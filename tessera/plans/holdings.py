"""Pension-fund holdings: cleaning, ranks, changes between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest, zfill

DISCLOSURE_LAG_DAYS = 7


def holdings_silver(raw: DataFrame, identity: DataFrame) -> DataFrame:
    code = zfill(F.regexp_replace(F.col("stock_code").cast("string"), "[^0-9A-Z]", ""), 6)
    df = raw.withColumn("stock_code", code).where("stock_code <> '' AND date IS NOT NULL")
    ids = identity.select(F.col("ticker").alias("stock_code"), F.col("security_id").alias("_sid"), F.col("listing_id").alias("_lid")).dropDuplicates(["stock_code"])
    df = df.join(F.broadcast(ids), "stock_code", "left").withColumn("security_id", F.coalesce("_sid", F.concat(F.lit("S"), "stock_code"))).withColumn("listing_id", F.coalesce("_lid", F.concat(F.lit("L"), "stock_code"))).drop("_sid", "_lid")
    return latest(df, ["date", "stock_code"], *[F.col(c).desc_nulls_last() for c in df.columns if c not in ("date", "stock_code")])


def holdings_universe(holdings: DataFrame) -> DataFrame:
    """Rank of each holding by market value within its date; ties go to the smaller code."""
    w = Window.partitionBy("date").orderBy(F.col("market_value").desc_nulls_last(), "stock_code")
    return holdings.withColumn("rank", F.row_number().over(w))


def holdings_delta(holdings: DataFrame, lag_days: int = DISCLOSURE_LAG_DAYS) -> DataFrame:
    """Changes between consecutive snapshots by one full outer join; the first snapshot has no row."""
    dates = holdings.select("date").distinct().withColumn("previous_date", F.lag("date").over(Window.orderBy("date"))).where("previous_date IS NOT NULL")
    dates = F.broadcast(dates)
    now = holdings.join(dates, "date").select("date", "previous_date", "security_id", F.col("ownership_pct").alias("current_ratio"), F.lit(True).alias("_now"))
    old = holdings.select(F.col("date").alias("previous_date"), "security_id", F.col("ownership_pct").alias("previous_ratio"), F.lit(True).alias("_old")).join(dates, "previous_date")
    both = now.join(old, ["date", "previous_date", "security_id"], "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return both.select(
        "date", "previous_date", F.date_add("date", lag_days).alias("available_date"), "security_id", "current_ratio", "previous_ratio", (zero("current_ratio") - zero("previous_ratio")).alias("delta_ratio"),
        F.col("_old").isNull().alias("entered"), F.col("_now").isNull().alias("exited"),
    )
