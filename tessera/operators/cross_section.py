"""Cross-sectional transforms: every date is a group; NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import average_rank, safe_div


def winsorize(df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99, by: str = "date") -> DataFrame:
    """Values beyond the group's linear quantiles become them."""
    w, x = Window.partitionBy(by), F.col(column)
    lo, hi = F.percentile(x, F.lit(lower)).over(w), F.percentile(x, F.lit(upper)).over(w)
    return df.withColumn(column, F.when(x.isNotNull(), F.greatest(F.least(x, hi), lo)))


def zscore(df: DataFrame, column: str, out: str | None = None, by: str = "date") -> DataFrame:
    """(x - mean) / sample deviation; NULL without deviation."""
    w, x = Window.partitionBy(by), F.col(column)
    return df.withColumn(out or column, safe_div(x - F.avg(x).over(w), F.stddev_samp(x).over(w)))


def rank_pct(df: DataFrame, column: str, out: str | None = None, by: str = "date") -> DataFrame:
    x = F.col(column)
    return df.withColumn(out or column, average_rank(x, by) / F.count(x).over(Window.partitionBy(by)))


def neutralize(df: DataFrame, column: str, groups: list[str], out: str | None = None, by: str = "date") -> DataFrame:
    """Deviation from the mean of the date's group."""
    x = F.col(column)
    return df.withColumn(out or column, x - F.avg(x).over(Window.partitionBy(by, *groups)))


def quantile_bucket(df: DataFrame, column: str, n: int, out: str = "bucket", by: str = "date") -> DataFrame:
    """0..n-1 by floor((average rank - 1) * n / count)."""
    x = F.col(column)
    rank = average_rank(x, by)
    return df.withColumn(out, F.floor((rank - 1) * n / F.count(x).over(Window.partitionBy(by))).cast("int"))


def size_bucket(df: DataFrame, column: str = "market_cap", n: int = 5, out: str = "bucket", by: str = "date") -> DataFrame:
    return quantile_bucket(df, column, n, out, by)
