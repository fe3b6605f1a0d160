"""Expressions with the semantics that research tables need: NULL instead of errors, infinities and NaN; explicit orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def is_finite(x: Column) -> Column:
    """True for finite numbers; False for NULL, NaN and infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def zfill(x: Column, width: int) -> Column:
    """Left-pads with zeros and never cuts, which lpad would."""
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


def number(x: Column) -> Column:
    """Text to double: commas go; '', '-' and 'N/A' are NULL."""
    cleaned = F.regexp_replace(F.trim(x), ",", "")
    return F.when(~cleaned.isin("", "-", "N/A"), cleaned).try_cast("double")


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def average_rank(x: Column, *by: Column | str) -> Column:
    """Ranks that ties share; NULL for NULL, which counts for no rank."""
    first = F.rank().over(Window.partitionBy(*by).orderBy(x.asc_nulls_last()))
    ties = F.count(x).over(Window.partitionBy(*by, x))
    return F.when(x.isNotNull(), first + (ties - 1) / 2)


def rolling(by: Sequence[str], order: str, rows: int) -> WindowSpec:
    """The last `rows` rows, the current one among them."""
    return Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)


def at_least(value: Column, count_of: Column, window: WindowSpec, n: int) -> Column:
    """value where the window has n or more non-null entries."""
    return F.when(F.count(count_of).over(window) >= n, value)


def rolling_std(df: DataFrame, x: str, by: Sequence[str], order: str, rows: int, least: int, name: str) -> DataFrame:
    """Adds the sample deviation of the last `rows` rows, where so many of them have a finite value.

    Running sums and their differences to `rows` rows before: the work doesn't grow with the frame, as it does where a sliding
    frame is summed anew for each row. Values are centred on the group's mean first, so that little cancels.
    """
    whole, line = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(order)
    run = line.rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(is_finite(F.col(x)), F.col(x))
    out = df.withColumn("_c", value - F.avg(value).over(whole))
    sums = {"_n": F.count("_c").over(run), "_s": F.sum("_c").over(run), "_q": F.sum(F.col("_c") * F.col("_c")).over(run)}
    out = out.withColumns(sums).withColumns({c: F.coalesce(F.col(c), F.lit(0)) - F.coalesce(F.lag(c, rows).over(line), F.lit(0)) for c in sums})
    spread = F.sqrt(F.greatest((F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1), F.lit(0.0)))
    return out.withColumn(name, F.when((F.col("_n") >= least) & (F.col("_n") > 1), spread)).drop("_c", *sums)


def pct_change(x: Column, n: int, by: Sequence[str], order: str, fill: bool = True) -> Column:
    """x / (x n rows before) - 1. With fill, a NULL takes the last value before it, as data frames in research usually do."""
    w = Window.partitionBy(*by).orderBy(order)
    if fill:
        x = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.try_divide(x, F.lag(x, n).over(w)) - 1
