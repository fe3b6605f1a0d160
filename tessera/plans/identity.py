"""Security identity: master, universe, relations, reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest
from tessera.operators.calendar import day_axis, ticker_reuse

DELISTING_BUFFER_DAYS = 10
REUSE_GAP_DAYS = 250
PREFERRED_NAME = r"(?:\d+)?우[A-Z]?$|우선"
SUFFIX = r"^\d?우(선주)?[A-Z]?$"


def is_preferred(ticker: Column, name: Column) -> Column:
    return F.coalesce(ticker.substr(-1, 1).isin("5", "7", "9"), F.lit(False)) | F.coalesce(name.rlike(PREFERRED_NAME), F.lit(False))


# What names of listed products hold, and the brands with which fund names begin; the first match wins.
PRODUCT_NAMES = (("spac_pre", "스팩|SPAC"), ("etn", "ETN"), ("reit", "리츠|REIT"))
FUND_BRANDS = ("KODEX", "TIGER", "ACE", "RISE", "HANARO", "SOL", "PLUS", "KOSEF", "ARIRANG", "WON", "TIMEFOLIO", "KBSTAR", "KINDEX")


def security_type(name: Column) -> Column:
    rules = [*PRODUCT_NAMES, ("etf", rf"^({'|'.join(FUND_BRANDS)})\s")]
    return F.coalesce(*[F.when(name.rlike(pattern), kind) for kind, pattern in rules], F.lit("equity"))


def delisting_cutoff(prices: DataFrame, buffer: int = DELISTING_BUFFER_DAYS) -> DataFrame:
    """One row: the trading day `buffer` days before the last, NULL where there are too few."""
    axis = day_axis(prices)
    last = axis.agg(F.max("day_index").alias("m"))
    return axis.join(F.broadcast(last)).agg(F.max(F.when(F.col("day_index") == F.col("m") - buffer, F.col("date"))).alias("cutoff"))


def security_master(prices: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """One row per ticker: last known name and market, first and last day, kind, and the day it vanished.

    Identity columns that no source fills (isin, delisting_reason) are there for those who merge them in. last_seen is what
    merge_master needs to tell a return from a delisting.
    """
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date")))
    g = prices.groupBy("ticker").agg(last("name").alias("name"), last("market").alias("market"), F.min("date").alias("listed_date"), F.max("date").alias("last_seen"))
    g = g.join(F.broadcast(delisting_cutoff(prices)))
    if companies is not None:
        snap = companies.agg(F.max("snapshot_dt").alias("snapshot_dt"))
        c = companies.join(F.broadcast(snap), "snapshot_dt", "left_semi")
        corp_name = F.col("corp_name") if "corp_name" in companies.columns else F.lit(None).cast("string")
        c = latest(c.select(F.col("stock_code").alias("ticker"), "corp_code", corp_name.alias("corp_name")), ["ticker"], F.col("corp_code").asc_nulls_last(), F.col("corp_name").asc_nulls_last())
        g = g.join(c, "ticker", "left")
    else:
        g = g.withColumn("corp_code", F.lit(None).cast("string")).withColumn("corp_name", F.lit(None).cast("string"))
    return g.select(
        F.concat(F.lit("I"), F.coalesce("corp_code", "ticker")).alias("issuer_id"), F.concat(F.lit("S"), "ticker").alias("security_id"), F.concat(F.lit("L"), "ticker").alias("listing_id"),
        "corp_code", "corp_name", F.lit(None).cast("string").alias("isin"), "ticker", "name", "market",
        F.when(is_preferred(F.col("ticker"), F.col("name")), "preferred").otherwise("common").alias("share_class"), security_type(F.col("name")).alias("security_type"), "listed_date",
        F.when(F.col("last_seen") < F.col("cutoff"), F.col("last_seen")).alias("delisted_date"),
        F.lit("unknown").alias("delisting_reason"), "last_seen",
    )


def merge_master(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earliest listing day; a known delisting day stays unless the security traded after it; what vanished from `new` stays."""
    o = old.select("security_id", F.col("listed_date").alias("_l"), F.col("delisted_date").alias("_d"))
    both = new.join(o, "security_id", "left")
    last = F.coalesce(F.col("last_seen"), F.col("delisted_date")) if "last_seen" in new.columns else F.col("delisted_date")
    both = both.withColumn("listed_date", F.least("listed_date", "_l")).withColumn("delisted_date", F.when(F.col("_d").isNotNull() & (last.isNull() | (last <= F.col("_d"))), F.col("_d")).otherwise(F.col("delisted_date"))).drop("_l", "_d")
    return both.unionByName(old.join(new, "security_id", "left_anti"), allowMissingColumns=True)


def identity_review(prices: DataFrame, gap: int = REUSE_GAP_DAYS) -> DataFrame:
    return ticker_reuse(prices.select("ticker", "date", "name"), gap)


def preferred_relations(names: DataFrame) -> DataFrame:
    """Preferred shares with the common share of the same first five characters; high confidence where the names agree."""
    n = names.select("security_id", "ticker", F.regexp_replace("name", r"(?U)\s+", "").alias("name"))
    p = n.where(F.col("ticker").rlike(r"^\d{5}[1-9A-Z]$") & F.coalesce(F.col("name").rlike(PREFERRED_NAME), F.lit(False)))
    p = p.select(F.col("security_id").alias("preferred_security_id"), F.col("ticker").alias("preferred_ticker"), F.col("name").alias("_pname"), F.substring("ticker", 1, 5).alias("_stem"))
    c = n.where(F.col("ticker").rlike(r"^\d{5}0$")).select(F.col("security_id").alias("common_security_id"), F.col("ticker").alias("common_ticker"), F.col("name").alias("_cname"), F.substring("ticker", 1, 5).alias("_stem"))
    both = p.join(c, "_stem")
    suffix = F.when(F.startswith("_pname", "_cname"), F.substr("_pname", F.length("_cname") + 1))
    sure = F.coalesce(suffix.rlike(SUFFIX), F.lit(False))
    return both.select("common_security_id", "preferred_security_id", "common_ticker", "preferred_ticker", F.lit("preferred_of").alias("relation_type"), F.when(sure, "high").otherwise("low").alias("confidence"))


def relation_spans(relations: DataFrame, prices: DataFrame) -> DataFrame:
    """First and last day on which both were seen; NULL where their ranges are disjoint."""
    span = prices.groupBy("security_id").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    side = lambda p: span.select(F.col("security_id").alias(f"{p}_security_id"), F.col("a").alias(f"_{p}a"), F.col("z").alias(f"_{p}z"))
    r = relations.join(side("common"), "common_security_id", "left").join(side("preferred"), "preferred_security_id", "left")
    first, last = F.greatest("_commona", "_preferreda"), F.least("_commonz", "_preferredz")
    return r.withColumn("valid_from", F.when(first <= last, first)).withColumn("valid_to", F.when(first <= last, last)).drop("_commona", "_commonz", "_preferreda", "_preferredz")


def universe_history(prices: DataFrame, master: DataFrame) -> DataFrame:
    m = master.select("ticker", "share_class", "security_type", "delisted_date", F.col("name").alias("_name"))
    j = prices.join(m, "ticker")
    active = F.col("delisted_date").isNull() | (F.col("date") <= F.col("delisted_date"))
    return j.select("date", "security_id", "ticker", active.alias("is_active"), "share_class", "security_type", (F.col("security_type") == "spac_pre").alias("is_spac_pre"))


def preferred_by_name(securities: DataFrame) -> DataFrame:
    """(corp_code, security_id, ticker): the preferred share of each corporation that has none by code: the only one among
    preferred shares without a code whose name begins with the common share's name.

    Names meet on their first character and are then compared, so no pair without a common beginning is made.
    """
    s = securities.where("name IS NOT NULL AND name <> '' AND security_id IS NOT NULL AND ticker IS NOT NULL")
    direct = s.where("corp_code IS NOT NULL")
    known = direct.where("share_class = 'preferred'").select("corp_code")
    common = direct.where("share_class = 'common'").join(known, "corp_code", "left_anti").select("corp_code", F.col("name").alias("_name"), F.substring("name", 1, 1).alias("_first"))
    free = s.where("corp_code IS NULL AND share_class = 'preferred'").select("security_id", "ticker", "name", F.substring("name", 1, 1).alias("_first"))
    both = common.join(free, "_first").where(F.startswith("name", "_name"))
    one = both.groupBy("corp_code").agg(F.count("*").alias("n"), F.min(F.struct("security_id", "ticker")).alias("s")).where("n = 1")
    return one.select("corp_code", "s.security_id", "s.ticker")


def resolve_listing(listings: DataFrame, ticker: str, on: str):
    """The one listing of a ticker active on a date."""
    day = F.to_date(F.lit(on))
    rows = listings.where((F.col("ticker") == ticker) & (F.col("listed_date") <= day) & (F.col("delisted_date").isNull() | (F.col("delisted_date") >= day))).limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{ticker} on {on}: {'none' if not rows else 'several'}")
    return rows[0]
