"""Financial statements: cleaning, and point-in-time snapshots that only see what was available strictly before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest, zfill

ANNUAL = ("11011", "annual")
SOURCE_GRAIN = ("corp_code", "fiscal_period_end", "report_type", "account_id", "statement_division", "is_consolidated", "account_detail", "sort_order", "rcept_no")
_ORDER = ("fiscal_period_end", "report_type", "statement_division", "available_date", "rcept_no", "is_consolidated", "account_detail", "sort_order")


def _scope() -> Column:
    return F.when(F.col("report_type").isin(*ANNUAL), "annual").otherwise("interim")


def _rank_columns(df: DataFrame) -> list[str]:
    return [c for c in ("fiscal_period_end", "report_type", "statement_division", "available_date", "is_consolidated", "rcept_no", "account_detail", "sort_order") if c in df.columns]


def pit_naive(financials: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Every statement available before every snapshot, then the best per (as_of_date, security, scope, account)."""
    f = financials.where("security_id IS NOT NULL").withColumn("period_scope", _scope())
    on = F.col("available_date") < F.col("as_of_date")
    if "security_id" in snapshots.columns:
        s = snapshots.withColumnRenamed("security_id", "_sid")
        joined = f.join(s, on & (F.col("security_id") == F.col("_sid"))).drop("_sid")
    else:
        joined = f.join(F.broadcast(snapshots), on)
    return latest(joined, ["as_of_date", "security_id", "period_scope", "account_id"], *[F.col(c).desc_nulls_last() for c in _rank_columns(f)])


def _numbered(snapshots: DataFrame) -> DataFrame:
    """(as_of_date, _day): the snapshot days with their numbers from 1."""
    days = snapshots.select("as_of_date").where("as_of_date IS NOT NULL").distinct()
    return days.withColumn("_day", F.row_number().over(Window.orderBy("as_of_date")))


def pit_spans(financials: DataFrame, snapshots: DataFrame, days: DataFrame) -> DataFrame:
    """The best statement per security, scope and account with the numbers (_first, _last) of the snapshot days that see it.

    A running maximum in order of availability gives the best statement so far: a late correction of an older period doesn't
    replace a newer one. Each stretch of availability becomes one span; its ends are looked up as day numbers. Where snapshots
    have securities, spans are cut to the runs of a security's own days. All of it is dealt by security alone, once, and so is
    what comes of it: nothing that is spread over days needs to be shuffled.
    """
    f = financials.where("security_id IS NOT NULL AND available_date IS NOT NULL").withColumn("period_scope", _scope()).repartition("security_id")
    keys = ["security_id", "period_scope", "account_id"]
    ranks = _rank_columns(f)
    best = F.struct(*[F.col(c) for c in ranks], *[F.col(c) for c in f.columns if c not in ranks and c not in keys])
    w = Window.partitionBy(*keys).orderBy("available_date").rangeBetween(Window.unboundedPreceding, 0)
    running = f.select(*keys, F.col("available_date").alias("_from"), F.max(best).over(w).alias("_best")).dropDuplicates([*keys, "_from"])
    until = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    spans = running.select(*keys, "_from", until.alias("_until"), "_best.*")
    # for every calendar date, how many snapshot days lie at or before it: a few thousand rows
    range_of = days.agg(F.min("as_of_date").alias("a"), F.max("as_of_date").alias("z")).where("a IS NOT NULL")
    dates = range_of.select(F.explode(F.sequence("a", "z")).alias("_date"))
    number = F.last("_day", ignorenulls=True).over(Window.orderBy("_date").rowsBetween(Window.unboundedPreceding, 0))
    dates = dates.join(days, F.col("_date") == F.col("as_of_date"), "left").select("_date", number.alias("_number"))
    ends = days.agg(F.min("as_of_date").alias("_start"), F.max("_day").alias("_days"))
    look = lambda c, name: dates.select(F.col("_date").alias(c), F.col("_number").alias(name))
    spans = spans.join(F.broadcast(look("_from", "_lo")), "_from", "left").join(F.broadcast(look("_until", "_hi")), "_until", "left").crossJoin(F.broadcast(ends))
    low = F.when(F.col("_from") < F.col("_start"), 0).otherwise(F.coalesce("_lo", "_days"))
    high = F.when(F.col("_until") < F.col("_start"), 0).otherwise(F.coalesce("_hi", "_days"))
    spans = spans.withColumn("_first", low + 1).withColumn("_last", high).drop("_from", "_until", "_lo", "_hi", "_start", "_days").where("_first <= _last")
    return cut_to_days(spans, snapshots, days)


def cut_to_days(spans: DataFrame, snapshots: DataFrame, days: DataFrame) -> DataFrame:
    """Spans (security_id, _first, _last, ...) without the days that a security's snapshots lack; runs of days are joined, not days."""
    if "security_id" not in snapshots.columns:
        return spans
    own = snapshots.where("security_id IS NOT NULL").select("security_id", "as_of_date").join(F.broadcast(days), "as_of_date")
    run = F.col("_day") - F.dense_rank().over(Window.partitionBy("security_id").orderBy("_day"))  # the same for days in a row, however often they stand
    runs = own.select("security_id", "_day", run.alias("_run")).groupBy("security_id", "_run").agg(F.min("_day").alias("_a"), F.max("_day").alias("_z")).drop("_run")
    both = spans.join(runs, "security_id").withColumn("_first", F.greatest("_first", "_a")).withColumn("_last", F.least("_last", "_z"))
    return both.drop("_a", "_z").where("_first <= _last")


def _spread(spans: DataFrame, days: DataFrame) -> DataFrame:
    each = spans.withColumn("_day", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    return each.join(F.broadcast(days), "_day").drop("_day")


def pit_intervals(financials: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The rows of `pit_naive`: spans of validity spread over their snapshot days; as many rows as the result has, equality joins only."""
    days = _numbered(snapshots)
    return _spread(pit_spans(financials, snapshots, days), days)


def pit_totals(financials: DataFrame, snapshots: DataFrame, kind: Column, value: Column) -> DataFrame:
    """(as_of_date, security_id, kind, n_accounts, total): rows of `pit_intervals` counted and their whole-number values summed.

    A span adds its value on its first day and takes it back after its last; running sums give totals that hold for days in a
    row, and only those are spread. Whole numbers make that exact.
    """
    days = _numbered(snapshots)
    spans = pit_spans(financials, snapshots.select("as_of_date"), days).select("security_id", kind.alias("kind"), value.cast("long").alias("v"), "_first", "_last")
    change = lambda day, sign: F.struct(day.alias("day"), F.lit(sign).alias("n"), (sign * F.col("v").isNotNull().cast("long")).alias("known"), (sign * F.coalesce("v", F.lit(0))).alias("v"))
    changes = spans.select("security_id", "kind", F.explode(F.array(change(F.col("_first"), 1), change(F.col("_last") + 1, -1))).alias("c"))
    steps = changes.groupBy("security_id", "kind", F.col("c.day").alias("_first")).agg(*[F.sum(f"c.{c}").alias(c) for c in ("n", "known", "v")])
    order = Window.partitionBy("security_id", "kind").orderBy("_first")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.select("security_id", "kind", "_first", (F.lead("_first").over(order) - 1).alias("_last"), *[F.sum(c).over(so_far).alias(c) for c in ("n", "known", "v")]).where("n > 0")
    out = _spread(cut_to_days(steps, snapshots, days), days)
    return out.select("as_of_date", "security_id", "kind", F.col("n").alias("n_accounts"), F.when(F.col("known") > 0, F.col("v")).alias("total"))


def normalize_account_id(account: Column) -> Column:
    """Custom ids ('-표준계정코드 미사용-' and blanks) are NULL; white space goes."""
    a = F.regexp_replace(account, r"(?U)\s+", "")
    return F.when((a != "") & ~a.startswith("-"), a)


# Account names of filings without standard ids.
NAMED_ACCOUNTS = {
    "자산총계": "ifrs-full_Assets", "부채총계": "ifrs-full_Liabilities", "자본총계": "ifrs-full_Equity",
    "기본주당이익(손실)": "ifrs-full_BasicEarningsLossPerShare", "기본주당손익": "ifrs-full_BasicEarningsLossPerShare",
}


def account_of_name(name: Column) -> Column:
    """The account id that a Korean account name stands for, NULL for other names; blanks and the unit at the end don't count."""
    bare = F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", ""), r"\(단위[:：]?원\)$", "")
    return F.create_map(*[F.lit(x) for pair in NAMED_ACCOUNTS.items() for x in pair])[bare]


def statement_requests(filings: DataFrame, report: Column, reports: tuple[str, ...], since: str, until: str) -> DataFrame:
    """(corp_code, stock_code, bsns_year, report_code, available_date): statements to ask for, once each, from their first filing.

    report: a struct of bsns_year and report_code, NULL for filings that are no statement.
    """
    day = F.col("rcept_dt").between(F.to_date(F.lit(since)), F.to_date(F.lit(until)))
    f = filings.where(day & F.col("stock_code").isNotNull()).select("corp_code", zfill(F.trim("stock_code"), 6).alias("stock_code"), report.alias("_r"), F.col("rcept_dt").alias("available_date"))
    f = f.select("corp_code", "stock_code", "_r.bsns_year", "_r.report_code", "available_date").where(F.col("report_code").isin(*reports))
    return f.groupBy("corp_code", "bsns_year", "report_code").agg(F.min_by("stock_code", F.struct("available_date", "stock_code")).alias("stock_code"), F.min("available_date").alias("available_date"))


def drop_shadowed(legacy: DataFrame, refreshed: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """Legacy rows whose grain has refreshed rows go."""
    keys = refreshed.select(*grain).distinct()
    return legacy.join(keys, list(grain), "left_anti")


def financials_silver(raw: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Maps corporations to securities, casts without raising, normalises accounts, keeps the newest row per source grain."""
    df = raw
    if companies is not None:
        c = companies.where(F.col("stock_code").rlike("^[0-9A-Z]{6}$")).select("corp_code", F.concat(F.lit("S"), "stock_code").alias("_mapped"))
        df = df.join(latest(c, ["corp_code"], F.col("_mapped")), "corp_code", "left")
        own = F.col("security_id") if "security_id" in raw.columns else F.lit(None).cast("string")
        df = df.withColumn("security_id", F.coalesce(own, "_mapped")).drop("_mapped")
    named = account_of_name(F.col("account_name")) if "account_name" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("account_id", F.coalesce(named, normalize_account_id(F.col("account_id")), F.col("account_id"))).withColumn("amount", F.col("amount").try_cast("double")).withColumn("fiscal_year", F.year("fiscal_period_end"))
    grain = [c for c in SOURCE_GRAIN if c in df.columns]
    others = [F.col(c).desc_nulls_last() for c in df.columns if c not in grain]
    return latest(df, grain, *([F.col("available_date").desc_nulls_last()] if "available_date" in df.columns else []), *others)


def annual_latest(financials: DataFrame, as_of: str) -> DataFrame:
    """Serving rule: rows available on or before a date, the latest fiscal period per security and account."""
    f = financials.where((F.col("available_date") <= F.to_date(F.lit(as_of))) & F.col("report_type").isin(*ANNUAL))
    return latest(f, ["security_id", "account_id"], F.col("fiscal_period_end").desc(), F.col("available_date").desc(), F.col("is_consolidated").desc(), F.col("rcept_no").desc())
