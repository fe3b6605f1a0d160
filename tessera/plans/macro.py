"""Macro series: changes, derived rates, range upserts; dividend and share-count normalisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest, number


def cpi_changes(series: DataFrame) -> DataFrame:
    """Adds yoy_pct and mom_pct against the same day 12 and 1 months before; NULL where that is missing or 0."""
    out = series
    for months, name in ((12, "yoy_pct"), (1, "mom_pct")):
        old = series.select("series_id", F.add_months("date", months).alias("date"), F.col("value").alias("_old")).groupBy("series_id", "date").agg(F.max("_old").alias("_old"))
        out = out.join(old, ["series_id", "date"], "left").withColumn(name, (F.try_divide(F.col("value"), F.col("_old")) - 1) * 100).drop("_old")
    return out


def index_returns(series: DataFrame) -> DataFrame:
    w = Window.partitionBy("series_id").orderBy("date")
    return series.withColumn("return_1d", F.try_divide("value", F.lag("value").over(w)) - 1)


def derived_fx(series: DataFrame, numerator: str, denominator: str, name: str) -> DataFrame:
    """numerator / denominator on common dates."""
    n = series.where(F.col("series_id") == numerator).select("date", F.col("value").alias("n"))
    d = series.where((F.col("series_id") == denominator) & (F.col("value") != 0)).select("date", F.col("value").alias("d"))
    return n.join(d, "date").select(F.lit(name).alias("series_id"), "date", (F.col("n") / F.col("d")).alias("value"))


def range_upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Per series, old rows within the range of the new ones go; then the new rows, last per (series, date)."""
    span = new.groupBy("series_id").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    kept = existing.join(F.broadcast(span.withColumnRenamed("series_id", "_s")), (F.col("series_id") == F.col("_s")) & F.col("date").between(F.col("a"), F.col("z")), "left_anti")
    once = latest(new, ["series_id", "date"], *[F.col(c).desc_nulls_last() for c in new.columns if c not in ("series_id", "date")])
    return kept.unionByName(once, allowMissingColumns=True)


# Labels of the three dividend metrics.
DIVIDEND_LABELS = {"주당 현금배당금(원)": "cash_dividend_per_share", "현금배당수익률(%)": "cash_dividend_yield_pct", "(연결)현금배당성향(%)": "payout_ratio_pct"}


def dividends_silver(raw: DataFrame) -> DataFrame:
    """Three fiscal years stand side by side in a row per metric: unpivots years, then pivots metrics."""
    tall = raw.select("corp_code", "security_id", "fiscal_year", "available_date", "label", F.expr("stack(3, 0, thstrm, 1, frmtrm, 2, lwfr) AS (back, value)"))
    metric = F.create_map(*[F.lit(x) for kv in DIVIDEND_LABELS.items() for x in kv])[F.col("label")]
    tall = tall.select("corp_code", "security_id", (F.col("fiscal_year") - F.col("back")).alias("fiscal_year"), "available_date", metric.alias("metric"), number(F.col("value")).alias("value"))
    wide = tall.where("metric IS NOT NULL").groupBy("corp_code", "security_id", "fiscal_year", "available_date").pivot("metric", list(DIVIDEND_LABELS.values())).agg(F.max("value"))
    return wide.where(" OR ".join(f"{c} IS NOT NULL" for c in DIVIDEND_LABELS.values()))


def share_class(label: Column) -> Column:
    """common, preferred, total or other from the label of a share-count row."""
    x = F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)\s+", "")
    return F.when(x.contains("합계"), "total").when(x.contains("우선"), "preferred").when(x.contains("보통"), "common").otherwise("other")


def share_counts_silver(raw: DataFrame) -> DataFrame:
    return raw.select("corp_code", "security_id", "fiscal_year", "available_date", share_class(F.col("se")).alias("share_class"), number(F.col("istc_totqy")).cast("long").alias("issued_shares"), number(F.col("tesstk_co")).cast("long").alias("treasury_shares"), number(F.col("distb_stock_co")).cast("long").alias("outstanding_shares"))


def report_period(title: Column) -> tuple[Column, Column]:
    """(fiscal year, report code) of titles such as '사업보고서 (2023.12)'."""
    year = F.regexp_extract(title, r"\((\d{4})\.(\d{2})\)", 1)
    month = F.regexp_extract(title, r"\((\d{4})\.(\d{2})\)", 2)
    code = F.when(title.contains("사업보고서"), "11011").when(title.contains("반기보고서"), "11012").when(title.contains("분기보고서") & (month == "03"), "11013").when(title.contains("분기보고서") & (month == "09"), "11014")
    return F.when(year != "", year.cast("int")), code


def upsert_latest(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, the new one per key."""
    both = existing.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, F.col("_n").desc(), *[F.col(c).desc_nulls_last() for c in existing.columns if c not in keys]).drop("_n")
