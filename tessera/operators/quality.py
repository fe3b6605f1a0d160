"""Data quality: checks, scorecard, fraud checks, audits, repairs; research tables over prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest, safe_div


def price_checks(prices: DataFrame, identities: DataFrame, jump: float = 0.3) -> DataFrame:
    """(check, count): all row checks in one pass over the prices, keys and identities in one aggregation each."""
    bad = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    w = Window.partitionBy("security_id").orderBy("date")
    p = prices.withColumn("_r", F.try_divide(F.col("close"), F.lag("close").over(w)) - 1)
    one = p.agg(
        F.count("*").alias("price_rows"),
        bad(F.coalesce((F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high")), F.lit(False))).alias("ohlc_violations"),
        bad(F.coalesce(F.abs("_r") > jump, F.lit(False))).alias("large_returns"),
    )
    keys = prices.groupBy("date", "security_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))
    unknown = prices.join(identities.select("security_id"), "security_id", "left_anti").agg(F.count("*").alias("unknown_identity"))
    wide = one.join(keys).join(unknown)
    names = ["price_rows", "ohlc_violations", "large_returns", "duplicate_keys", "unknown_identity"]
    return wide.select(F.expr(f"stack({len(names)}, {', '.join(f"'{n}', {n}" for n in names)}) AS (check_name, n_rows)"))


def source_mismatch(prices: DataFrame, a: str, b: str, tolerance: float = 0.001) -> DataFrame:
    """(date, ticker, a, b) where two sources differ by more than the tolerance."""
    wide = prices.where(F.col("source").isin(a, b)).groupBy("date", "ticker").pivot("source", [a, b]).agg(F.max("close"))
    return wide.where(F.abs(safe_div(F.col(a), F.col(b)) - 1) > tolerance)


# Trading days after which a dataset's newest partition is old (None: never), and whether it may be missing.
DATASET_LIMITS = {
    "silver.prices": (2, False), "silver.market_caps": (130, False), "gold.daily_prices_adj": (2, False), "gold.daily_market_caps": (2, False),
    "gold.fundamentals_pit": (45, False), "silver.financials": (45, False), "silver.filings": (10, False), "silver.dividends": (260, False),
    "silver.share_counts": (260, False), "silver.nps_holdings": (130, True), "silver.corporate_actions": (None, True), "gold.universe_history": (2, False),
    "gold.filing_events": (10, False), "gold.nps_universe": (130, True), "gold.preferred_discount": (2, False),
}


def lake_scorecard(partitions: DataFrame, calendar: DataFrame, limits: dict[str, tuple[int | None, bool]] | None = None) -> DataFrame:
    """Grades of all datasets that a lake should have, each by its own limit; a missing one gets F, or A where it may be missing."""
    limits = limits or DATASET_LIMITS
    specs = calendar.sparkSession.createDataFrame([(k, days, may) for k, (days, may) in limits.items()], "dataset string, limit_days int, may_be_empty boolean")
    g = scorecard(partitions, calendar, 0).drop("grade").join(F.broadcast(specs), "dataset", "right")
    share = safe_div(F.col("rows").cast("double"), F.col("typical_rows").cast("double"))
    fresh = F.when(F.col("age_days") > 3 * F.col("limit_days"), 2).when(F.col("age_days") > F.col("limit_days"), 1).otherwise(0)
    full = F.when(share < 0.1, 2).when(share < 0.5, 1).otherwise(0)
    worst = F.when(F.col("last_date").isNull(), F.when(F.col("may_be_empty"), 0).otherwise(2)).otherwise(F.greatest(fresh, full))
    return g.withColumn("grade", F.element_at(F.array(F.lit("A"), F.lit("C"), F.lit("F")), worst + 1)).drop("may_be_empty")


def scorecard(partitions: DataFrame, calendar: DataFrame, limit_days: int, trailing: int = 20) -> DataFrame:
    """Grades of datasets from rows per partition date: (dataset, last_date, age_days, rows, typical_rows, grade).

    Freshness: more than the limit of trading days old is C, more than three times F. Completeness: the last partition has less
    than half (C) or a tenth (F) of the upper median of the partitions before it. The worse one counts.
    """
    rank = Window.partitionBy("dataset").orderBy(F.col("date").desc())
    p = partitions.withColumn("_k", F.row_number().over(rank)).where(F.col("_k") <= trailing + 1)
    old = F.array_sort(F.collect_list(F.when(F.col("_k") > 1, F.col("rows"))))
    g = p.groupBy("dataset").agg(F.max("date").alias("last_date"), F.max(F.when(F.col("_k") == 1, F.col("rows"))).alias("rows"), old.alias("_old"))
    typical = F.when(F.size("_old") > 0, F.element_at("_old", F.floor(F.size("_old") / 2).cast("int") + 1))
    newest = calendar.agg(F.max("day_index").alias("_now"))
    g = g.withColumn("typical_rows", typical).join(F.broadcast(calendar.select(F.col("date").alias("last_date"), "day_index")), "last_date", "left").join(F.broadcast(newest))
    g = g.withColumn("age_days", F.col("_now") - F.col("day_index"))
    share = safe_div(F.col("rows").cast("double"), F.col("typical_rows").cast("double"))
    fresh = F.when(F.col("age_days") > 3 * limit_days, 2).when(F.col("age_days") > limit_days, 1).otherwise(0)
    full = F.when(share < 0.1, 2).when(share < 0.5, 1).otherwise(0)
    return g.select("dataset", "last_date", "age_days", "rows", "typical_rows", F.element_at(F.array(F.lit("A"), F.lit("C"), F.lit("F")), F.greatest(fresh, full) + 1).alias("grade"))


def fraud_checks(held: DataFrame, names: DataFrame, prices: DataFrame, tiny: int = 30, penny: float = 1000.0) -> DataFrame:
    """Per signal date: tiny_universe, spac_names, penny_names of a backtest's holdings."""
    h = held.join(names.select("security_id", "name"), "security_id", "left").join(prices.select(F.col("date").alias("signal_date"), "security_id", "close"), ["signal_date", "security_id"], "left")
    flag = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    return h.groupBy("signal_date").agg(F.count("*").alias("n"), (F.count("*") < tiny).alias("tiny_universe"), flag(F.col("name").contains("스팩")).alias("spac_names"), flag(F.col("close") < penny).alias("penny_names"))


def row_count_gate(partitions: DataFrame, share: float = 0.95, least: int = 100) -> DataFrame:
    """(date, rows, previous_rows, ok): today's rows against int(share * previous), where previous has `least` or more."""
    p = partitions.withColumn("previous_rows", F.lag("rows").over(Window.orderBy("date")))
    failed = (F.col("previous_rows") >= least) & (F.col("rows") < F.floor(F.col("previous_rows") * share))
    return p.withColumn("ok", ~F.coalesce(failed, F.lit(False)))


def jump_audit(prices: DataFrame, threshold: float) -> DataFrame:
    """Returns of at least the threshold with the closes around them."""
    w = Window.partitionBy("security_id").orderBy("date")
    p = prices.select("date", "security_id", F.lag("close_adj").over(w).alias("previous_close"), "close_adj", "return_1d")
    return p.where(F.abs("return_1d") >= threshold)


def flagged_jumps(audit: DataFrame, cluster: int) -> DataFrame:
    """Jumps with audit_flag: clustered_date where a day has at least so many, else zero_volume, halted or large_return. audit: date, volume, is_halted."""
    first = F.when(F.coalesce("volume", F.lit(0)) == 0, "zero_volume").when(F.coalesce("is_halted", F.lit(False)), "halted").otherwise("large_return")
    days = audit.groupBy("date").agg(F.count("*").alias("_n")).where(F.col("_n") >= cluster)
    j = audit.join(days, "date", "left")
    return j.withColumn("audit_flag", F.when(F.col("_n").isNotNull(), "clustered_date").otherwise(first)).drop("_n")


def jump_summary(flagged: DataFrame) -> DataFrame:
    """Per security: number of jumps, first and last day, the largest, and its flags in order."""
    size = F.abs("return_1d")
    return flagged.groupBy("security_id").agg(F.count("*").alias("event_count"), F.min("date").alias("first_event_date"), F.max("date").alias("last_event_date"), F.max(size).alias("max_abs_return"), F.array_join(F.array_sort(F.collect_set("audit_flag")), "|").alias("flags"))


def jump_clusters(audit: DataFrame) -> DataFrame:
    """Per date: number of jumps and the securities, joined in order."""
    return audit.groupBy("date").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("security_id")), "|").alias("securities"))


def quarantine(prices: DataFrame, keys: DataFrame) -> DataFrame:
    """return_1d becomes NULL for audited (date, security_id)."""
    k = keys.select("date", "security_id").distinct().withColumn("_q", F.lit(True))
    return prices.join(k, ["date", "security_id"], "left").withColumn("return_1d", F.when(F.col("_q").isNull(), F.col("return_1d"))).drop("_q")


def repair(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with those of `fresh` in place of rows of the same key."""
    return stored.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def shadow_compare(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(status, n): missing, extra, changed and equal rows of b against a."""
    j = a.select(*keys, F.col(value).alias("_a"), F.lit(1).alias("_l")).join(b.select(*keys, F.col(value).alias("_b"), F.lit(1).alias("_r")), keys, "full_outer")
    status = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("changed")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def removal_impact(contributions: DataFrame) -> DataFrame:
    """Per year: index return R, and R without the one security whose removal changes it most. contributions: year, security_id, start_cap, end_cap."""
    w = Window.partitionBy("year")
    c = contributions.where("start_cap > 0")
    s, e = F.sum("start_cap").over(w), F.sum("end_cap").over(w)
    c = c.withColumn("index_return", e / s - 1).withColumn("return_without", safe_div(e - F.col("end_cap"), s - F.col("start_cap")) - 1)
    c = c.withColumn("impact", F.col("index_return") - F.col("return_without"))
    return latest(c, ["year"], F.col("impact").desc_nulls_last(), F.col("security_id")).select("year", "security_id", "index_return", "return_without", "impact")


def surge_table(panel: DataFrame, column: str, edges: list[float], outcome: str) -> DataFrame:
    """(bucket, n, mean, hit_rate) of an outcome by ranges of a column; bucket k holds values from edge k-1 up to edge k."""
    bucket = F.lit(0)
    for edge in edges:
        bucket = bucket + F.when(F.col(column) >= edge, 1).otherwise(0)
    p = panel.where(F.col(column).isNotNull() & F.col(outcome).isNotNull()).withColumn("bucket", bucket)
    return p.groupBy("bucket").agg(F.count("*").alias("n"), F.avg(outcome).alias("mean"), F.avg((F.col(outcome) > 0).cast("double")).alias("hit_rate"))


def decile_table(panel: DataFrame, column: str, outcome: str, n: int = 10) -> DataFrame:
    """(decile, n, mean, low, high): groups of a column between its exact linear quantiles, which an aggregation gives."""
    p = panel.where(F.col(column).isNotNull() & F.col(outcome).isNotNull())
    cuts = [k / n for k in range(1, n)]
    edges = p.agg(F.percentile(F.col(column), F.array(*[F.lit(c) for c in cuts])).alias("_e"))
    j = p.join(F.broadcast(edges)).withColumn("decile", F.size(F.filter("_e", lambda e: e < F.col(column))) + 1)
    return j.groupBy("decile").agg(F.count("*").alias("n"), F.avg(outcome).alias("mean"), F.min(column).alias("low"), F.max(column).alias("high"))


def fixed_effects_ols(panel: DataFrame, y: str, x: list[str], entity: str) -> DataFrame:
    """(term, beta, se): least squares within entities with cluster-robust errors.

    Demeaning is a window per entity; X'X and X'y are sums, and so are the clusters' scores. What reaches the driver is k x k."""
    import numpy as np

    rows = panel.select(entity, y, *x).dropna()
    w = Window.partitionBy(entity)
    d = rows.select(entity, *[(F.col(c) - F.avg(c).over(w)).alias(c) for c in (y, *x)])
    k = len(x)
    sums = d.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"x{i}_{j}") for i, a in enumerate(x) for j, b in enumerate(x)], *[F.sum(F.col(a) * F.col(y)).alias(f"y{i}") for i, a in enumerate(x)], F.count("*").alias("n"), F.countDistinct(entity).alias("g")).first()
    spark = panel.sparkSession
    if not sums["n"]:
        return spark.createDataFrame([], "term string, beta double, se double")
    xtx = np.array([[sums[f"x{i}_{j}"] for j in range(k)] for i in range(k)])
    beta = np.linalg.solve(xtx, np.array([sums[f"y{i}"] for i in range(k)]))
    residual = F.col(y) - sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, x, strict=True)), F.lit(0.0))
    scores = d.withColumn("_u", residual).groupBy(entity).agg(*[F.sum(F.col(c) * F.col("_u")).alias(f"s{i}") for i, c in enumerate(x)])
    meat = scores.agg(*[F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]).first()
    inner = np.linalg.inv(xtx)
    cov = inner @ np.array([[meat[f"m{i}_{j}"] for j in range(k)] for i in range(k)]) @ inner
    g, n = sums["g"], sums["n"]
    scale = (g / (g - 1)) * ((n - 1) / (n - k)) if g > 1 and n > k else 1.0
    return spark.createDataFrame([(c, float(b), float((scale * cov[i, i]) ** 0.5)) for i, (c, b) in enumerate(zip(x, beta, strict=True))], "term string, beta double, se double")
