"""Normalisers of raw source rows: pure DataFrame transforms, no network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import number, zfill


def first_of(df: DataFrame, *names: str) -> Column:
    """The first present, non-empty column of several spellings; NULL without any."""
    have = [F.when(F.trim(F.col(f"`{n}`").cast("string")) != "", F.col(f"`{n}`").cast("string")) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def _whole(x: Column) -> Column:
    return F.round(number(x)).cast("long")


def krx_daily(raw: DataFrame, day: str) -> DataFrame:
    """Exchange rows: `ISU_SRT_CD`-style or plain keys, numbers with commas."""
    f = lambda *n: first_of(raw, *n)
    out = raw.select(
        F.to_date(F.lit(day)).alias("date"), zfill(f("ISU_SRT_CD", "ISU_CD", "ticker"), 6).alias("ticker"), f("ISU_CD", "isin").alias("isin"), f("ISU_ABBRV", "ISU_NM", "name").alias("name"), f("MKT_NM", "market").alias("market"),
        number(f("TDD_OPNPRC", "open")).alias("open"), number(f("TDD_HGPRC", "high")).alias("high"), number(f("TDD_LWPRC", "low")).alias("low"), number(f("TDD_CLSPRC", "close")).alias("close"),
        _whole(f("ACC_TRDVOL", "volume")).alias("volume"), _whole(f("ACC_TRDVAL", "trading_value")).alias("trading_value"), _whole(f("MKTCAP", "market_cap")).alias("market_cap"), _whole(f("LIST_SHRS", "listed_shares")).alias("listed_shares"),
    )
    return out.where("ticker IS NOT NULL")


def kis_daily(raw: DataFrame, ticker: str) -> DataFrame:
    """Broker rows: yyyymmdd dates and plain numbers."""
    f = lambda *n: first_of(raw, *n)
    return raw.select(
        F.expr("NULL").cast("string").alias("isin"), F.try_to_timestamp(f("stck_bsop_date", "date"), F.lit("yyyyMMdd")).cast("date").alias("date"), F.lit(ticker.zfill(6)).alias("ticker"),
        *[number(f(a, b)).alias(b) for a, b in (("stck_oprc", "open"), ("stck_hgpr", "high"), ("stck_lwpr", "low"), ("stck_clpr", "close"))], _whole(f("acml_vol", "volume")).alias("volume"), _whole(f("acml_tr_pbmn", "trading_value")).alias("trading_value"),
    ).where("date IS NOT NULL")


def naver_summary(raw: DataFrame, day: str) -> DataFrame:
    """Portal rows: caps come in 100 millions, shares in thousands, and a fall is told by the word 하락."""
    f = lambda *n: first_of(raw, *n)
    change = F.abs(_whole(F.regexp_extract(f("change_text", "change"), r"[\d,]+", 0)))
    signed = F.when(f("change_text", "change").contains("하락"), -change).otherwise(change)
    return raw.select(
        F.to_date(F.lit(day)).alias("snapshot_dt"), zfill(F.regexp_extract(f("ticker", "code"), r"[0-9A-Z]+", 0), 6).alias("ticker"), F.trim(f("name")).alias("name"), f("market").alias("market"), _whole(f("close")).alias("close"), signed.alias("change_abs"),
        number(F.regexp_replace(f("change_rate", "change_rate_pct"), "[%+]", "")).alias("change_rate_pct"), _whole(f("par_value")).alias("par_value"), F.round(number(f("market_cap")) * 100_000_000).cast("long").alias("market_cap"),
        F.round(number(f("listed_shares")) * 1_000).cast("long").alias("listed_shares"), number(f("foreign_ownership_pct")).alias("foreign_ownership_pct"), _whole(f("volume")).alias("volume"), number(f("per")).alias("per"), number(f("roe")).alias("roe"),
    ).where("ticker <> ''")


def dart_filings(raw: DataFrame, lag_days: int = 1) -> DataFrame:
    """Disclosure rows; a filing is available the day after it was received."""
    day = F.try_to_timestamp(F.col("rcept_dt").cast("string"), F.lit("yyyyMMdd")).cast("date")
    return raw.withColumn("rcept_dt", day).withColumn("available_date", F.date_add("rcept_dt", lag_days)).where("rcept_no IS NOT NULL")


def dart_financials(raw: DataFrame) -> DataFrame:
    """Statement rows: amounts with commas or in parentheses for negatives, consolidation from fs_div."""
    text = F.col("thstrm_amount").cast("string")
    amount = F.when(text.startswith("("), -number(F.regexp_replace(text, "[()]", ""))).otherwise(number(text))
    return raw.withColumn("amount", amount).withColumn("is_consolidated", F.col("fs_div") == "CFS").withColumn("accounting_basis", F.lit("K-IFRS"))


def read_csv(spark, path: str, ddl: str, header: bool = True) -> DataFrame:
    """CSV with a declared schema; a bad row fails the read."""
    return spark.read.schema(ddl).option("header", header).option("mode", "FAILFAST").csv(path)


def legacy_holdings(path: str, table: str = "holdings") -> list[tuple]:
    """Rows of a legacy SQLite file in their order, with their position as rank: a file for one machine, read by the driver."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        rows = db.execute(f'SELECT * FROM "{table.replace(chr(34), "")}" ORDER BY rowid').fetchall()
    return [(k, *row) for k, row in enumerate(rows, 1)]


def enrich_holdings_prices(holdings: DataFrame, prices: DataFrame, lookback_days: int = 20) -> DataFrame:
    """Latest close not after the source date within the lookback; shares = round(value / close) where shares are missing."""
    from tessera.operators.asof import asof

    p = prices.where("close > 0").groupBy(F.col("ticker").alias("stock_code"), "date").agg(F.max("close").alias("_close")).withColumnRenamed("date", "price_date")
    j = asof(holdings.drop("price", "price_date"), p, ["stock_code"], "source_date", "price_date", ["_close"], lookback_days)
    return j.withColumnRenamed("matched_price_date", "price_date").withColumnRenamed("_close", "price").withColumn("shares", F.coalesce("shares", F.round(F.try_divide(F.col("market_value"), F.col("price"))).cast("long"))).withColumn("is_exact_price", F.col("price_date") == F.col("source_date"))
