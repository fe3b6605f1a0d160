"""Filings: cleaning, event classification, event studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest
from tessera.operators.asof import asof
from tessera.operators.calendar import day_axis

# Event type, title pattern, expected sign; the first match wins.
EVENT_PATTERNS = (
    ("buyback_disposal", r"자기주식\s*처분", -1),
    ("buyback", r"자기주식\s*취득\s*결정", 1),
    ("buyback", r"자기주식\s*취득\s*신탁계약\s*체결", 1),
    ("rights_issue", r"유상증자\s*결정", -1),
    ("bonus_issue", r"무상증자\s*결정", 1),
    ("convertible_bond", r"(전환사채|신주인수권부사채|교환사채).{0,8}발행\s*결정", -1),
    ("capital_reduction", r"감자\s*결정", -1),
    ("stock_split", r"주식\s*분할\s*결정", 1),
    ("stock_merge", r"주식\s*병합\s*결정", 0),
    ("merger", r"(합병|분할)\s*결정", 0),
    ("dividend", r"(현금|현물).{0,4}배당\s*결정", 1),
    ("major_holder_change", r"최대주주\s*변경", 0),
    ("supply_contract", r"(단일판매|공급계약).{0,10}체결", 1),
    ("embezzlement", r"횡령|배임", -1),
    ("delisting_risk", r"관리종목|상장폐지|감사의견", -1),
)


def bare_title(title: Column) -> Column:
    """Without leading [...] tags, the blanks around them, and blanks at the ends."""
    return F.regexp_replace(F.regexp_replace(title, r"(?U)^(\s*\[[^\]]*\])+", ""), r"(?U)^\s+|\s+$", "")


def event_type(title: Column) -> Column:
    return F.coalesce(*[F.when(title.rlike(f"(?U){pattern}"), kind) for kind, pattern, _ in EVENT_PATTERNS])


def event_sign(kind: Column) -> Column:
    """The expected sign of an event type; the rules of one type share it."""
    signs = {kind: sign for kind, _, sign in EVENT_PATTERNS}
    return F.create_map(*[F.lit(x) for pair in signs.items() for x in pair])[kind]


def describe_event_patterns() -> list[dict]:
    """The rules in order, each with the number of rules of its type."""
    kinds = [k for k, _, _ in EVENT_PATTERNS]
    return [{"event_type": k, "pattern": p, "expected_sign": s, "n_patterns": kinds.count(k)} for k, p, s in EVENT_PATTERNS]


def filings_silver(raw: DataFrame) -> DataFrame:
    """Valid codes, the correction flag, the newest row per receipt number."""
    code = F.trim("stock_code")
    df = raw.withColumn("stock_code", F.when(code.rlike("^[0-9A-Z]{6}$"), code)).withColumn("security_id", F.concat(F.lit("S"), "stock_code"))
    df = df.withColumn("is_correction", F.coalesce(F.col("rm").contains("정"), F.lit(False)))
    return latest(df, ["rcept_no"], F.col("rcept_dt").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in sorted(df.columns) if c != "rcept_dt"])


def filing_events(filings: DataFrame) -> DataFrame:
    """Classified filings; a correction counts only where it is the first filing of its security and type."""
    df = filings.where("security_id IS NOT NULL").withColumn("_title", bare_title(F.col("report_nm")))
    # exploding what matched drops the rest, and evaluates the rules once, where a filter would evaluate them again
    df = df.withColumn("event_type", F.explode(F.array_compact(F.array(event_type(F.col("_title")))))).withColumn("expected_sign", event_sign(F.col("event_type"))).drop("_title")
    flag = F.coalesce(F.col("is_correction"), F.lit(False)) | F.coalesce(F.col("report_nm").rlike(r"\[[^\]]*정정[^\]]*\]"), F.lit(False))
    w = Window.partitionBy("security_id", "event_type").orderBy("rcept_dt", "rcept_no")
    df = df.withColumn("is_correction", flag).withColumn("_order", F.row_number().over(w)).where("NOT is_correction OR _order = 1")
    return df.select(F.col("rcept_dt").alias("event_date"), "available_date", "security_id", F.col("stock_code").alias("ticker"), "event_type", "expected_sign", "rcept_no", "report_nm", "is_correction")


def study_windows(events: DataFrame, axis: DataFrame, pre: int, post: int) -> DataFrame:
    """One row per event and relative day; day 0 is the first trading day strictly after availability."""
    once = events.select("security_id", "available_date").distinct()
    dates = once.select("available_date").where("available_date IS NOT NULL").distinct()
    # the next trading day of each date: one ordered pass over dates, a row per day
    zero = asof(dates, axis, [], "available_date", "date", ["day_index"], allow_equal=False, forward=True).where("day_index IS NOT NULL")
    zero = zero.select("available_date", F.col("day_index").alias("day0"))
    spread = once.join(F.broadcast(zero), "available_date").withColumn("rel_day", F.explode(F.sequence(F.lit(-pre), F.lit(post))))
    return spread.withColumn("day_index", F.col("day0") + F.col("rel_day")).join(F.broadcast(axis), "day_index")


def abnormal_returns(prices: DataFrame) -> DataFrame:
    """(date, security_id, ar): return less the equal-weight mean of all securities that day."""
    r = prices.where("return_1d IS NOT NULL").select("date", "security_id", "return_1d")
    market = r.groupBy("date").agg(F.avg("return_1d").alias("market"))
    return r.join(market, "date").select("date", "security_id", (F.col("return_1d") - F.col("market")).alias("ar"))


def event_study(events: DataFrame, prices: DataFrame, pre: int = 5, post: int = 20, coverage: float = 0.7, min_events: int = 10, axis: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(by relative day, one row of summary). Events with less than this share of their days go; fewer than min_events raise."""
    axis = axis if axis is not None else day_axis(prices)
    seen = study_windows(events, axis, pre, post).join(abnormal_returns(prices), ["date", "security_id"])
    event = ["security_id", "available_date"]
    seen = seen.withColumn("_n", F.count("*").over(Window.partitionBy(*event))).where(F.col("_n") >= coverage * (pre + post + 1))
    if min_events and seen.select(*event).distinct().limit(min_events).count() < min_events:
        raise ValueError(f"fewer than {min_events} events")
    seen = seen.withColumn("car", F.sum("ar").over(Window.partitionBy(*event).orderBy("rel_day").rowsBetween(Window.unboundedPreceding, 0)))
    by_day = seen.groupBy("rel_day").agg(F.avg("ar").alias("mean_ar"), F.median("ar").alias("median_ar"), F.avg("car").alias("mean_car"), F.count("*").alias("n"))
    part = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("ar"))), F.lit(0.0))
    per_event = seen.groupBy(*event).agg(part(F.col("rel_day") < 0).alias("pre"), part(F.col("rel_day") == 0).alias("day0"), part(F.col("rel_day") > 0).alias("post"), F.sum("ar").alias("whole"))
    summary = per_event.agg(F.count("*").alias("n_events"), F.avg("pre").alias("car_pre"), F.avg("day0").alias("ar_day0"), F.avg("post").alias("car_post"), F.avg("whole").alias("car_full"), F.avg((F.col("whole") > 0).cast("double")).alias("hit_rate"))
    return by_day, summary
