"""Factor analytics: forward returns, information coefficients, quantile returns, turnover."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import average_rank, is_finite, safe_div
from tessera.operators.cross_section import quantile_bucket


def forward_returns(prices: DataFrame, horizon: int = 1, price: str = "close_adj") -> DataFrame:
    """(date, security_id, forward_return): price `horizon` rows ahead over today's, less 1."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    w = Window.partitionBy("security_id").orderBy("date")
    return prices.select("date", "security_id", (safe_div(F.lead(price, horizon).over(w), F.col(price)) - 1).alias("forward_return"))


def _paired(scores: DataFrame, returns: DataFrame) -> DataFrame:
    both = scores.select("date", "security_id", "score").join(returns.select("date", "security_id", "forward_return"), ["date", "security_id"])
    return both.where(is_finite(F.col("score")) & is_finite(F.col("forward_return")))


def information_coefficient(scores: DataFrame, returns: DataFrame, method: str = "spearman") -> DataFrame:
    """(date, ic, n): correlation of scores and forward returns, NULL without variance."""
    if method not in ("spearman", "pearson"):
        raise ValueError("method must be spearman or pearson")
    both = _paired(scores, returns)
    if method == "spearman":
        both = both.select("date", average_rank(F.col("score"), "date").alias("score"), average_rank(F.col("forward_return"), "date").alias("forward_return"))
    spread = F.stddev_samp("score") * F.stddev_samp("forward_return")
    return both.groupBy("date").agg(safe_div(F.covar_samp("score", "forward_return"), spread).alias("ic"), F.count("*").alias("n"))


def quantile_returns(scores: DataFrame, returns: DataFrame, q: int = 5) -> DataFrame:
    """(date, quantile 1..q, mean_return, n)."""
    if q < 2:
        raise ValueError("q must be at least 2")
    cut = quantile_bucket(_paired(scores, returns), "score", q, "quantile").withColumn("quantile", F.col("quantile") + 1)
    return cut.groupBy("date", "quantile").agg(F.avg("forward_return").alias("mean_return"), F.count("*").alias("n"))


def top_names(scores: DataFrame, top_fraction: float, direction: int = 1) -> DataFrame:
    """Per date the best max(1, ceil(n * fraction)) finite scores; ties go to the smaller security_id."""
    best = Window.partitionBy("date").orderBy((F.col("score") * direction).desc(), F.col("security_id"))
    ranked = scores.where(is_finite(F.col("score"))).withColumn("_rank", F.row_number().over(best)).withColumn("_n", F.count("*").over(Window.partitionBy("date")))
    return ranked.withColumn("_k", F.greatest(F.lit(1), F.ceil(F.col("_n") * top_fraction))).where("_rank <= _k").drop("_rank", "_n")


def factor_turnover(scores: DataFrame, top_fraction: float = 0.1) -> DataFrame:
    """(date, overlap, n): share of today's top names that were top on the date before; NULL on the first date."""
    top = top_names(scores, top_fraction).select("date", "security_id")
    dates = top.select("date").distinct().withColumn("previous", F.lag("date").over(Window.orderBy("date")))
    now = top.join(F.broadcast(dates), "date")
    before = top.select(F.col("date").alias("previous"), "security_id", F.lit(1).alias("stayed"))
    both = now.join(before, ["previous", "security_id"], "left")
    return both.groupBy("date").agg(F.when(F.first("previous").isNotNull(), F.coalesce(F.sum("stayed"), F.lit(0)) / F.count("*")).alias("overlap"), F.count("*").alias("n"))
