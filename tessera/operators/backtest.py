"""Rebalanced portfolio backtests as one plan: schedules, selection, positions, returns, costs, NAV.

The only thing that passes from one rebalance to the next is the previous target weights, which is a join of schedule k with
k - 1. The calendar and the schedules are tables of a few thousand rows at most and are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import is_finite
from tessera.operators.asof import asof
from tessera.operators.calendar import day_axis, month_ends, shift


@dataclass(frozen=True)
class BacktestConfig:
    start: str
    end: str
    top_fraction: float = 0.1
    signal_lag_days: int = 1
    entry_lag_days: int = 1
    max_position_weight: float = 0.2
    missing_return: float = 0.0
    drop_after_missing: bool = True
    exclude_flagged: bool = True
    charge_final_liquidation: bool = False
    share_classes: tuple[str, ...] = ("common",)
    initial: float = 1.0

    def __post_init__(self) -> None:
        if not 0 < self.top_fraction <= 1 or not 0 < self.max_position_weight <= 1 or self.signal_lag_days < 0 or self.entry_lag_days < 1 or self.start > self.end:
            raise ValueError("bad backtest configuration")


@dataclass(frozen=True)
class FixedBps:
    bps: float = 10.0

    def cost(self, buys: Column, sells: Column) -> Column:
        return (buys + sells) * self.bps / 10_000


@dataclass(frozen=True)
class KoreanCosts:
    commission_bps: float = 5.0
    sell_tax_bps: float = 15.0

    def cost(self, buys: Column, sells: Column) -> Column:
        return (buys + sells) * self.commission_bps / 10_000 + sells * self.sell_tax_bps / 10_000


@dataclass(frozen=True)
class Quotes:
    """Returns without the days between prices: `returns` (date, security_id, return_1d) of days with a price of their own, `since`
    (security_id, since) the day of the first price. On any other day after `since` the price stands and the return is 0."""

    returns: DataFrame
    since: DataFrame


def schedules(axis: DataFrame, c: BacktestConfig) -> DataFrame:
    """(k, signal_date, entry_date, exit_date): one row per rebalance."""
    ends = month_ends(axis, c.start, c.end)
    s = shift(ends.select((F.col("day_index") - c.signal_lag_days).alias("day_index"), F.col("date").alias("rebalance_date")), axis, 0, "signal_date")
    s = shift(s, axis, c.entry_lag_days, "entry_date").where(F.col("entry_date").between(F.to_date(F.lit(c.start)), F.to_date(F.lit(c.end))))
    order = Window.orderBy("entry_date", "signal_date")
    return s.select(F.row_number().over(order).alias("k"), "signal_date", "entry_date", F.coalesce(F.lead("entry_date").over(order), F.to_date(F.lit(c.end))).alias("exit_date"))


def holding_days(plan: DataFrame, axis: DataFrame) -> DataFrame:
    """(k, date): the trading days in (entry, exit] of each rebalance, by day index; an exit that is no trading day ends before it."""
    ends = asof(plan.select("k", "entry_date", "exit_date"), axis, [], "exit_date", "date", ["day_index"]).select("k", "entry_date", F.col("day_index").alias("to"))
    starts = axis.select(F.col("date").alias("entry_date"), F.col("day_index").alias("from"))
    span = ends.join(F.broadcast(starts), "entry_date").where("to > from")
    days = span.select("k", F.explode(F.sequence(F.col("from") + 1, F.col("to"))).alias("day_index"))
    return days.join(F.broadcast(axis.select("day_index", "date")), "day_index").select("k", "date")


def active_universe(universe: DataFrame, c: BacktestConfig) -> DataFrame:
    flags = [f for f in ("is_halted", "is_designated", "is_liquidation_window") if f in universe.columns] if c.exclude_flagged else []
    keep = F.coalesce(F.col("is_active"), F.lit(False)) & F.col("share_class").isin(*c.share_classes) & ~F.coalesce(F.col("is_spac_pre"), F.lit(False))
    for flag in flags:
        keep = keep & ~F.coalesce(F.col(flag), F.lit(False))
    return universe.where(keep).select(F.col("date").alias("signal_date"), "security_id").distinct()


def targets(scores: DataFrame, universe: DataFrame, plan: DataFrame, c: BacktestConfig, direction: int) -> DataFrame:
    """(k, signal_date, entry_date, exit_date, security_id, weight, selected_count)."""
    s = scores.where(is_finite(F.col("score"))).select(F.col("date").alias("signal_date"), "security_id", "score")
    # only the days of signals are shuffled
    members = universe.join(F.broadcast(plan.select(F.col("signal_date").alias("date")).distinct()), "date", "left_semi")
    s = s.join(F.broadcast(plan), "signal_date").join(active_universe(members, c), ["signal_date", "security_id"], "left_semi")
    best = Window.partitionBy("k").orderBy((F.col("score") * direction).desc(), "security_id")
    s = s.withColumn("r", F.row_number().over(best)).withColumn("n", F.count("*").over(Window.partitionBy("k")))
    s = s.withColumn("selected_count", F.greatest(F.lit(1), F.ceil(F.col("n") * c.top_fraction)).cast("long")).where(F.col("r") <= F.col("selected_count"))
    return s.select("k", "signal_date", "entry_date", "exit_date", "security_id", F.least(F.lit(c.max_position_weight), 1.0 / F.col("selected_count")).alias("weight"), "selected_count")


def positions(chosen: DataFrame, plan: DataFrame, axis: DataFrame) -> DataFrame:
    """A row per holding and trading day in (entry, exit]."""
    held = chosen.join(F.broadcast(holding_days(plan, axis)), "k")
    return held.select("date", "security_id", "weight", "k", "signal_date", "entry_date")


def attribute(held: DataFrame, prices: DataFrame | Quotes, c: BacktestConfig) -> DataFrame:
    """Adds contribution and missing: the first day without a return earns missing_return; after it nothing, if dropped."""
    sparse = isinstance(prices, Quotes)
    r = (prices.returns if sparse else prices).select("date", "security_id", F.col("return_1d").alias("r"))
    if sparse:
        r = r.where(F.col("date").between(F.to_date(F.lit(c.start)), F.to_date(F.lit(c.end))))
    j = held.join(r, ["date", "security_id"], "left")
    if sparse:
        j = j.join(prices.since, "security_id", "left").withColumn("r", F.coalesce("r", F.when(F.col("date") > F.col("since"), 0.0))).drop("since")
    j = j.withColumn("missing", F.col("r").isNull())
    before = Window.partitionBy("k", "security_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    gone = F.coalesce(F.max(F.col("missing").cast("int")).over(before), F.lit(0)) == 1
    earned = F.when(gone & F.lit(c.drop_after_missing), 0.0).when(F.col("missing"), F.lit(c.missing_return)).otherwise(F.col("r"))
    return j.withColumn("contribution", F.col("weight") * earned)


def ledger(chosen: DataFrame, plan: DataFrame, cost_model, attributed: DataFrame | None = None) -> DataFrame:
    """Per rebalance: selected_count, buys, sells, turnover, entry_cost, missing_positions."""
    now = chosen.select("k", "security_id", "weight")
    old = now.select((F.col("k") + 1).alias("k"), "security_id", F.col("weight").alias("old"))
    moves = now.join(old, ["k", "security_id"], "full_outer").withColumn("d", F.coalesce("weight", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))
    flows = moves.groupBy("k").agg(F.sum(F.greatest("d", F.lit(0.0))).alias("buys"), F.sum(F.greatest(-F.col("d"), F.lit(0.0))).alias("sells"), F.count("weight").alias("selected_count"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    out = plan.join(flows, "k", "left").withColumn("buys", zero("buys")).withColumn("sells", zero("sells")).withColumn("selected_count", F.coalesce("selected_count", F.lit(0)))
    out = out.withColumn("turnover", F.col("buys") + F.col("sells")).withColumn("entry_cost", cost_model.cost(F.col("buys"), F.col("sells")))
    if attributed is not None:
        gaps = attributed.where("missing").groupBy("k").agg(F.countDistinct("security_id").alias("missing_positions"))
        out = out.join(gaps, "k", "left").withColumn("missing_positions", F.coalesce("missing_positions", F.lit(0)))
    return out


def nav(attributed: DataFrame, book: DataFrame, axis: DataFrame, c: BacktestConfig, final: DataFrame | None = None) -> DataFrame:
    """(date, gross_return, cost, net_return, nav) for every trading day of the range."""
    days = axis.where(F.col("date").between(F.to_date(F.lit(c.start)), F.to_date(F.lit(c.end)))).select("date")
    gross = attributed.groupBy("date").agg(F.sum("contribution").alias("gross_return"))
    costs = book.select(F.col("entry_date").alias("date"), F.col("entry_cost").alias("cost"))
    if final is not None:
        costs = costs.unionByName(final)
    costs = costs.groupBy("date").agg(F.sum("cost").alias("cost"))
    out = days.join(gross, "date", "left").join(costs, "date", "left").fillna(0.0, ["gross_return", "cost"])
    out = out.withColumn("net_return", F.col("gross_return") - F.col("cost"))
    return out.withColumn("nav", F.lit(c.initial) * F.product(1 + F.col("net_return")).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)))


def summary(curve: DataFrame, book: DataFrame) -> DataFrame:
    """One row: total_return, gross_growth, cost_drag, max_drawdown, days, average_turnover."""
    peak = F.max("nav").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    c = curve.withColumn("drawdown", F.col("nav") / F.greatest(peak, F.lit(1.0)) - 1)
    one = c.agg((F.max_by("nav", "date") - 1).alias("total_return"), F.product(1 + F.col("gross_return")).alias("gross_growth"), F.sum("cost").alias("cost_drag"), F.min("drawdown").alias("max_drawdown"), F.count("*").alias("days"))
    return one.join(book.agg(F.avg("turnover").alias("average_turnover"), F.count("*").alias("rebalances")))


@dataclass
class BacktestResult:
    nav: DataFrame
    positions: DataFrame
    ledger: DataFrame
    targets: DataFrame


def run(
    scores: DataFrame, universe: DataFrame, prices: DataFrame | Quotes, c: BacktestConfig, direction: int = 1, cost_model=None, axis: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> BacktestResult:
    """keep: may store the selection and the attributed holdings, each of which is read several times. Quotes need an axis."""
    cost_model = cost_model or FixedBps()
    axis = axis if axis is not None else day_axis(prices)
    plan = schedules(axis, c)
    chosen = keep(targets(scores, universe, plan, c, direction))
    held = positions(chosen, plan, axis)
    attributed = keep(attribute(held, prices, c))
    book = ledger(chosen, plan, cost_model, attributed)
    final = None
    if c.charge_final_liquidation:
        last_k = chosen.agg(F.max("k").alias("k"))
        end = axis.where(F.col("date").between(F.to_date(F.lit(c.start)), F.to_date(F.lit(c.end)))).agg(F.max("date").alias("date"))
        sold = chosen.join(F.broadcast(last_k), "k").agg(F.sum("weight").alias("w")).where("w IS NOT NULL")
        final = sold.join(end).select("date", cost_model.cost(F.lit(0.0), F.col("w")).alias("cost"))
    return BacktestResult(nav(attributed, book, axis, c, final), held, book, chosen)
