"""Prices: candidates of several sources, corporate actions, adjustment, market caps, preferred discounts.

Everything is computed from the whole history given: a rebuild of part of it and of all of it agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import at_least, latest, rolling, zfill

PRIORITY = {"krx": 0, "kis": 1, "naver": 2, "pre2010": 3}
BASIS = {"naver": "adjusted", "pre2010": "unknown"}
JUMP_MIN, JUMP_MAX, CROSS_TOLERANCE, CAP_TOLERANCE = 1.5, 100.0, 0.35, 0.25
FILING_BEFORE_DAYS, FILING_AFTER_DAYS = 120, 14
# Titles of filings about splits, merges and capital reductions.
SPLIT_TITLE, MERGE_TITLE, CUT_TITLE = "주식분할|액면분할", "주식병합|액면병합|감자", "감자"


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def priority(source: Column) -> Column:
    out = F.lit(9)
    for name, rank in PRIORITY.items():
        out = F.when(source == name, rank).otherwise(out)
    return out


def normalize_prices(raw: DataFrame, source: str) -> DataFrame:
    """Six-digit tickers, ids, the day's true range, source and basis, flags."""
    ticker = zfill(F.trim(F.col("ticker").cast("string")), 6)
    num = lambda c: F.col(c).try_cast("double")
    df = raw.withColumn("ticker", ticker)
    df = df.withColumns({c: num(c) for c in ("open", "high", "low", "close")})
    df = df.withColumns({"high": F.greatest("open", "high", "low", "close"), "low": F.least("open", "high", "low", "close")})
    return df.withColumns({
        "security_id": F.concat(F.lit("S"), "ticker"), "listing_id": F.concat(F.lit("L"), "ticker"), "price_source": F.lit(source), "price_basis": F.lit(BASIS.get(source, "raw")),
        "is_halted": F.lit(False), "is_designated": F.lit(False), "is_liquidation_window": F.lit(False),
    }).where("date IS NOT NULL AND ticker IS NOT NULL")


def enrich(prices: DataFrame, side: DataFrame, market_first: str) -> DataFrame:
    """Fills name, market, cap and shares from one row per (date, ticker); market_first tells whose market wins: own or side."""
    s = side.select("date", "ticker", F.col("name").alias("_name"), F.col("market").alias("_market"), F.col("market_cap").alias("_cap"), F.col("listed_shares").alias("_shares"))
    j = prices.join(s, ["date", "ticker"], "left")
    name = F.when(F.col("name").isNull() | (F.col("name") == F.col("ticker")), F.coalesce("_name", "name")).otherwise(F.col("name"))
    market = F.coalesce("market", "_market") if market_first == "own" else F.coalesce("_market", "market")
    return j.withColumns({"name": name, "market": market, "market_cap": F.coalesce("market_cap", "_cap"), "listed_shares": F.coalesce("listed_shares", "_shares")}).drop("_name", "_market", "_cap", "_shares")


def dedup_candidates(candidates: DataFrame, source: str = "source", strategy: str = "continuity") -> DataFrame:
    """One row per (date, ticker). Of several, the one whose close continues its neighbours best.

    Anchors are the nearest dates before and after that have a single candidate; the score is the sum of absolute log ratios
    to them. Order: more anchors, lower score, source priority, then close and volume. strategy `max_close` keeps the highest
    close instead.
    """
    day = Window.partitionBy("date", "ticker")
    if strategy == "max_close":
        return latest(candidates, ["date", "ticker"], F.col("close").desc_nulls_last(), priority(F.col(source)), F.col("volume").desc_nulls_last())
    c = candidates.withColumn("_n", F.count("*").over(day))
    anchor = F.when((F.col("_n") == 1) & (F.col("close") > 0), F.col("close"))
    line = Window.partitionBy("ticker").orderBy("date")
    c = c.withColumn("_before", F.last(anchor, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    # the next anchor is the last one of the reversed order: a growing frame is extended row by row, a shrinking one computed anew
    back = Window.partitionBy("ticker").orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_after", F.last(anchor, ignorenulls=True).over(back))
    gap = lambda a: F.when((F.col("close") > 0) & F.col(a).isNotNull(), F.abs(F.log(F.col("close") / F.col(a))))
    c = c.withColumn("_b", gap("_before")).withColumn("_a", gap("_after"))
    anchors = F.col("_b").isNotNull().cast("int") + F.col("_a").isNotNull().cast("int")
    score = F.coalesce("_b", F.lit(0.0)) + F.coalesce("_a", F.lit(0.0))
    w = day.orderBy(anchors.desc(), score.asc(), priority(F.col(source)), F.col("close").asc_nulls_last(), F.col("volume").asc_nulls_last())
    return c.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_n", "_before", "_after", "_b", "_a", "_r")


def preferred_source(candidates: DataFrame, source: str = "source") -> DataFrame:
    return latest(candidates, ["date", "ticker"], priority(F.col(source)), F.col(source))


def silver_prices(sources: dict[str, DataFrame], naver: DataFrame | None = None, caps: DataFrame | None = None) -> DataFrame:
    """All sources through normalising, enriching, dedup within a source, and preference between sources."""
    parts = []
    for name, raw in sources.items():
        p = normalize_prices(raw, name)
        p = enrich(p, naver, "side") if naver is not None else p
        p = enrich(p, caps, "own") if caps is not None else p
        parts.append(dedup_candidates(p, "price_source"))
    return preferred_source(union_by_name(*parts), "price_source")


def share_jumps(prices: DataFrame) -> DataFrame:
    """Splits and merges: listed shares jump while the price moves against them and the cap goes on."""
    w = Window.partitionBy("security_id").orderBy("date")
    p = prices.where("close > 0 AND listed_shares > 0")
    p = p.select("security_id", "ticker", F.col("date").alias("effective_date"), "close", "listed_shares", "market_cap", *[F.lag(c).over(w).alias(f"_{c}") for c in ("close", "listed_shares", "market_cap")])
    p = p.withColumn("shares_ratio", F.col("listed_shares") / F.col("_listed_shares")).withColumn("close_ratio", F.col("close") / F.col("_close"))
    jump = F.greatest(F.col("shares_ratio"), 1 / F.col("shares_ratio"))
    p = p.where(F.col("_close").isNotNull() & jump.between(JUMP_MIN, JUMP_MAX) & (F.abs(F.col("close_ratio") * F.col("shares_ratio") - 1) <= CROSS_TOLERANCE))
    known = F.col("market_cap").isNotNull() & F.col("_market_cap").isNotNull() & (F.col("_market_cap") != 0)
    p = p.where(~known | (F.abs(F.try_divide("market_cap", "_market_cap") - 1) <= CAP_TOLERANCE))
    kind = F.when(F.col("shares_ratio") > 1, "split").otherwise("merge")
    return p.select("security_id", "ticker", "effective_date", kind.alias("action_type"), (1 / F.col("shares_ratio")).alias("factor"), F.lit("medium").alias("confidence"), F.lit("shares_jump").alias("action_source"))


def corroborate(actions: DataFrame, filings: DataFrame) -> DataFrame:
    """Actions with a fitting filing from 120 days before to 14 days after become high in confidence; the nearest filing counts
    (of equally near ones the lowest receipt number) and names the action."""
    title = F.col("report_nm")
    split, merge, cut = (F.coalesce(title.rlike(p), F.lit(False)) for p in (SPLIT_TITLE, MERGE_TITLE, CUT_TITLE))
    named = F.when(cut, "capital_reduction").when(split, "split").otherwise("merge")
    f = filings.where(split | merge).where("stock_code IS NOT NULL AND rcept_dt IS NOT NULL")
    # a title may speak of both; it is then there for either kind of action
    kinds = F.explode(F.filter(F.array(F.when(split, "split"), F.when(merge, "merge")), lambda k: k.isNotNull()))
    f = f.select(zfill(F.trim("stock_code"), 6).alias("_t"), F.col("rcept_dt").alias("_filed"), F.col("rcept_no").alias("_no"), named.alias("_named"), kinds.alias("_kind"))
    own = actions if "source_rcept_no" in actions.columns else actions.withColumn("source_rcept_no", F.lit(None).cast("string"))
    kind = F.when(F.col("action_type") == "split", "split").otherwise("merge")
    within = F.col("_filed").between(F.date_sub("effective_date", FILING_BEFORE_DAYS), F.date_add("effective_date", FILING_AFTER_DAYS))
    j = own.join(f, (F.col("ticker") == F.col("_t")) & (kind == F.col("_kind")) & within, "left")
    j = latest(j, ["security_id", "effective_date", "action_type"], F.abs(F.datediff("effective_date", "_filed")).asc_nulls_last(), F.col("_no").asc_nulls_last())
    j = j.withColumn("confidence", F.when(F.col("_no").isNotNull(), "high").otherwise(F.col("confidence")))
    j = j.withColumns({"action_type": F.coalesce("_named", "action_type"), "source_rcept_no": F.coalesce("_no", "source_rcept_no")})
    return j.drop("_t", "_filed", "_no", "_named", "_kind")


def adjusted_prices(prices: DataFrame, actions: DataFrame) -> DataFrame:
    """Back-adjusted prices of raw rows and returns.

    A row's factor is the product of the factors of all later actions. Prices and actions are united in one ordered window
    per security, so nothing is expanded: the product runs from the end backwards.
    """
    valid = latest(actions.where("factor > 0"), ["security_id", "effective_date"], F.col("action_type"), F.col("factor"))
    shape = prices.withColumn("_row", F.struct(*prices.columns))
    p = shape.select("security_id", "date", F.lit(1).alias("_side"), F.lit(1.0).alias("_f"), "_row")
    a = valid.select("security_id", F.col("effective_date").alias("date"), F.lit(0).alias("_side"), F.col("factor").alias("_f"), F.lit(None).cast(p.schema["_row"].dataType).alias("_row"))
    # backwards in time; an action comes after the rows of its own day, so that they keep their price
    back = Window.partitionBy("security_id").orderBy(F.col("date").desc(), F.col("_side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    j = p.unionByName(a).withColumn("_factor", F.product("_f").over(back)).where("_side = 1").select("_row.*", "_factor")
    j = j.withColumn("_factor", F.when(F.col("price_basis") == "raw", F.col("_factor")).otherwise(F.lit(1.0)))
    out = j.withColumns({f"{c}_adj": F.col(c) * F.col("_factor") for c in ("open", "high", "low", "close") if c in prices.columns}).withColumnRenamed("_factor", "adjustment_factor")
    w = Window.partitionBy("security_id").orderBy("date")
    filled = F.last("close_adj", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("_c", filled)
    traded = (F.col("volume") > 0) & (F.lag("volume").over(w) > 0) & F.lag("price_source").over(w).eqNullSafe(F.col("price_source"))
    return out.withColumn("return_1d", F.when(traded, F.try_divide(F.col("_c"), F.lag("_c").over(w)) - 1)).drop("_c")


def merge_actions(stored: DataFrame, detected: DataFrame) -> DataFrame:
    """Stored actions of other sources stay and win over a detected one of the same security and day; detected ones are those found now."""
    kept = stored.where(F.col("source").isNull() | (F.col("source") != "shares_jump"))
    return kept.unionByName(detected.join(kept.select("effective_date", "security_id"), ["effective_date", "security_id"], "left_anti"), allowMissingColumns=True)


def stale_securities(actions: DataFrame, applied: DataFrame) -> DataFrame:
    """Securities whose events (day and factor) differ between the actions now and those a stored history was adjusted with."""
    event = lambda df: df.select("security_id", "effective_date", F.round("factor", 9).alias("factor"))
    now, then = event(actions), event(applied)
    return now.subtract(then).unionByName(then.subtract(now)).select("security_id").distinct()


def update_adjusted(stored: DataFrame, prices: DataFrame, actions: DataFrame, applied: DataFrame) -> DataFrame:
    """The adjusted history after new prices or actions: equal to adjusted_prices of all, but only stale securities are redone.

    Other securities get rows for days that aren't stored, from their last stored close on. stored: what adjusted_prices gave.
    """
    stale = stale_securities(actions, applied)
    last = stored.where("close_adj IS NOT NULL").groupBy("security_id").agg(F.max("date").alias("_last"))
    redone = adjusted_prices(prices.join(stale, "security_id", "left_semi"), actions)
    tail = prices.join(stale, "security_id", "left_anti").join(last, "security_id", "left").where("_last IS NULL OR date >= _last").drop("_last")
    added = adjusted_prices(tail, actions).join(stored.select("security_id", "date"), ["security_id", "date"], "left_anti")
    return union_by_name(stored.join(stale, "security_id", "left_anti"), redone, added)


def daily_market_caps(existing: DataFrame | None, caps: DataFrame, prices: DataFrame) -> DataFrame:
    """Caps of the cap source and of prices; one row per (date, ticker), first by source name; dates already held are left out."""
    own = prices.where("market_cap IS NOT NULL").select("date", "ticker", "market_cap", F.col("price_source").alias("market_cap_source"))
    both = caps.select("date", "ticker", "market_cap", "market_cap_source").unionByName(own)
    if existing is not None:
        both = both.join(F.broadcast(existing.select("date").distinct()), "date", "left_anti")
    return latest(both, ["date", "ticker"], F.col("market_cap_source"), F.col("market_cap").desc_nulls_last())


def preferred_discount(prices: DataFrame, relations: DataFrame, window: int = 252, least: int = 120) -> DataFrame:
    """1 - preferred / common with its rolling mean, deviation and z-score over common trading days."""
    side = lambda p: prices.select("date", F.col("security_id").alias(f"{p}_security_id"), F.col("close").alias(f"{p}_close"))
    r = relations.select("common_security_id", "preferred_security_id")
    j = side("preferred").join(F.broadcast(r), "preferred_security_id").join(side("common"), ["date", "common_security_id"]).where("common_close > 0")
    j = j.withColumn("discount", 1 - F.col("preferred_close") / F.col("common_close"))
    w, x = rolling(["preferred_security_id", "common_security_id"], "date", window), F.col("discount")
    j = j.withColumn("discount_mean", at_least(F.avg(x).over(w), x, w, least)).withColumn("discount_std", at_least(F.stddev_samp(x).over(w), x, w, least))
    return j.withColumn("discount_z", F.when(F.col("discount_std") > 0, (x - F.col("discount_mean")) / F.col("discount_std")))
