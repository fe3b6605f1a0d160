"""The factor library: each factor is a function of named tables and gives (date, security_id, score)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import at_least, is_finite, latest, pct_change, rolling, rolling_std, safe_div
from tessera.operators.asof import asof
from tessera.operators.cross_section import zscore

# Account ids in order of preference.
NET_INCOME = ("ifrs-full_ProfitLossAttributableToOwnersOfParent", "ifrs-full_ProfitLoss", "profit_loss", "net_income")
ASSETS = ("ifrs-full_Assets", "assets", "total_assets")
EQUITY = ("ifrs-full_EquityAttributableToOwnersOfParent", "ifrs-full_Equity", "equity", "total_equity")
GROSS_PROFIT = ("ifrs-full_GrossProfit", "gross_profit")
REVENUE = ("ifrs-full_Revenue", "revenue")
COST_OF_SALES = ("ifrs-full_CostOfSales", "cost_of_sales")
OPERATING_CASH_FLOW = ("ifrs-full_CashFlowsFromUsedInOperatingActivities", "operating_cash_flow")
ANNUAL = ("11011", "annual")

PRICES, PIT, CAPS = "gold.daily_prices_adj", "gold.fundamentals_pit", "gold.daily_market_caps"
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Factor:
    name: str
    compute: Callable[[Tables], DataFrame]
    requires: tuple[str, ...]
    direction: int = 1
    rebalance: str = "monthly"


_registry: dict[str, Factor] = {}


def register(factor: Factor) -> Factor:
    if factor.name in _registry:
        raise KeyError(f"factor {factor.name} is registered already")
    _registry[factor.name] = factor
    return factor


def get(name: str) -> Factor:
    return _registry[name]


def names() -> list[str]:
    return sorted(_registry)


def describe() -> list[dict]:
    return [{"name": f.name, "direction": f.direction, "requires": list(f.requires), "rebalance": f.rebalance} for _, f in sorted(_registry.items())]


def factor(name: str, *requires: str, direction: int = 1):
    def add(f: Callable[[Tables], DataFrame]):
        register(Factor(name, f, requires, direction))
        return f

    return add


def _scored(df: DataFrame, score: Column) -> DataFrame:
    return df.select("date", "security_id", score.alias("score"))


def _momentum(prices: DataFrame, n: int) -> Column:
    return pct_change(F.col("close_adj"), n, ["security_id"], "date")


@factor("momentum_12_1", PRICES)
def momentum_12_1(t: Tables) -> DataFrame:
    p = t[PRICES]
    both = p.select("date", "security_id", _momentum(p, 252).alias("long"), _momentum(p, 21).alias("short"))
    return _scored(both, safe_div(1 + F.col("long"), 1 + F.col("short")) - 1)


def momentum_on(days: DataFrame, rows_on: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """momentum_12_1 on some days (date, day_index) of prices without gaps. rows_on gives the prices' rows (day_index, security_id,
    close_adj) on the days asked for, so that no other day is read."""
    back = {"now": 0, "short": 21, "long": 252}
    asked = [F.struct((F.col("day_index") - n).alias("day_index"), F.lit(name).alias("what")) for name, n in back.items()]
    need = days.select("date", F.explode(F.array(*asked)).alias("x")).select("date", "x.*")
    rows = rows_on(need.select("day_index")).select("day_index", "security_id", "close_adj").join(F.broadcast(need), "day_index")
    p = rows.groupBy("security_id", "date").agg(*[F.max(F.when(F.col("what") == name, F.col("close_adj"))).alias(name) for name in back]).where("now IS NOT NULL")
    change = lambda c: safe_div(F.col("now"), F.col(c)) - 1
    return _scored(p, safe_div(1 + change("long"), 1 + change("short")) - 1)


@factor("reversal_1m", PRICES, direction=-1)
def reversal_1m(t: Tables) -> DataFrame:
    return _scored(t[PRICES], _momentum(t[PRICES], 21))


@factor("momentum_52w_high", PRICES)
def momentum_52w_high(t: Tables, window: int = 252, least: int = 200) -> DataFrame:
    w, x = rolling(["security_id"], "date", window), F.col("close_adj")
    return _scored(t[PRICES], safe_div(x, at_least(F.max(x).over(w), x, w, least)))


@factor("lowvol_252", PRICES, direction=-1)
def lowvol_252(t: Tables, window: int = 252, least: int = 200) -> DataFrame:
    p = rolling_std(t[PRICES].select("date", "security_id", "return_1d"), "return_1d", ["security_id"], "date", window, least, "spread")
    return _scored(p, F.col("spread"))


def first_account(accounts: tuple[str, ...]) -> Column:
    """Of a group's amounts, that of the first account that has one; of several amounts the largest."""
    return F.coalesce(*[F.max(F.when(F.col("account_id") == a, F.col("amount"))) for a in accounts])


def _annual(t: Tables, **columns: tuple[str, ...]) -> DataFrame:
    rows = t[PIT].where(F.col("report_type").isin(*ANNUAL)).where(F.col("account_id").isin(*[a for c in columns.values() for a in c]))
    return rows.groupBy(F.col("as_of_date").alias("date"), "security_id").agg(*[first_account(a).alias(k) for k, a in columns.items()])


def _over_cap(t: Tables, accounts: tuple[str, ...]) -> DataFrame:
    caps = t[PRICES].select("date", "security_id", "market_cap").where("market_cap > 0")
    return _scored(_annual(t, x=accounts).join(caps, ["date", "security_id"]), safe_div("x", "market_cap"))


@factor("value_earnings_yield", PIT, PRICES)
def value_earnings_yield(t: Tables) -> DataFrame:
    return _over_cap(t, NET_INCOME)


@factor("value_book_to_price", PIT, PRICES)
def value_book_to_price(t: Tables) -> DataFrame:
    return _over_cap(t, EQUITY)


@factor("quality_roa", PIT)
def quality_roa(t: Tables) -> DataFrame:
    return _scored(_annual(t, income=NET_INCOME, assets=ASSETS), safe_div("income", "assets"))


@factor("quality_gpa", PIT)
def quality_gpa(t: Tables) -> DataFrame:
    a = _annual(t, gross=GROSS_PROFIT, revenue=REVENUE, cost=COST_OF_SALES, assets=ASSETS)
    return _scored(a, safe_div(F.coalesce("gross", F.col("revenue") - F.col("cost")), F.col("assets")))


@factor("quality_accruals", PIT, direction=-1)
def quality_accruals(t: Tables) -> DataFrame:
    a = _annual(t, income=NET_INCOME, cash=OPERATING_CASH_FLOW, assets=ASSETS)
    return _scored(a, safe_div(F.col("income") - F.col("cash"), F.col("assets")))


@factor("value_dividend_yield", "silver.dividends", PRICES)
def value_dividend_yield(t: Tables, stale_days: int = 430) -> DataFrame:
    """Dividend per share over price, known the day after it became available."""
    d = t["silver.dividends"].where(F.col("report_type").isin(*ANNUAL) & F.col("cash_dividend_per_share").isNotNull())
    d = latest(d, ["security_id", "available_date"], F.col("fiscal_period_end").desc(), F.col("cash_dividend_per_share").desc())
    d = d.select("security_id", F.date_add("available_date", 1).alias("effective"), "cash_dividend_per_share")
    m = asof(t[PRICES].select("date", "security_id", "listed_shares", "market_cap"), d, ["security_id"], "date", "effective", ["cash_dividend_per_share"], stale_days)
    return _scored(m, safe_div(F.col("cash_dividend_per_share") * F.col("listed_shares"), F.col("market_cap")))


@factor("nps_flow", "gold.nps_holdings_delta", PRICES)
def nps_flow(t: Tables, stale_days: int = 370) -> DataFrame:
    d = t["gold.nps_holdings_delta"].groupBy("security_id", F.date_add("available_date", 1).alias("effective")).agg(F.max_by("delta_ratio", "date").alias("delta_ratio"))
    m = asof(t[PRICES].select("date", "security_id"), d, ["security_id"], "date", "effective", ["delta_ratio"], stale_days)
    return _scored(m, F.col("delta_ratio"))


@factor("event_buyback", "gold.filing_events", PRICES)
def event_buyback(t: Tables, decay_days: float = 21.0, stale_days: int = 91) -> DataFrame:
    """exp(-age / decay) of the last buyback, whose age counts from its availability."""
    d = t["gold.filing_events"].where("event_type = 'buyback'").select("security_id", "available_date", F.date_add("available_date", 1).alias("effective")).distinct()
    m = asof(t[PRICES].select("date", "security_id"), d, ["security_id"], "date", "effective", ["available_date"], stale_days)
    return _scored(m, F.exp(-F.datediff("date", "available_date") / F.lit(decay_days)))


@factor("preferred_discount_z", "gold.preferred_discount")
def preferred_discount_z(t: Tables) -> DataFrame:
    d = t["gold.preferred_discount"]
    return d.select("date", F.col("preferred_security_id").alias("security_id"), F.col("discount_z").alias("score"))


def composite(t: Tables, components: list[str], weights: list[float] | None = None) -> DataFrame:
    """Weighted mean of the components' z-scores, turned by direction; weights are renormalised over what is present."""
    weights = weights or [1.0] * len(components)
    if len(weights) != len(components) or not components:
        raise ValueError("one weight per component is needed")
    parts: list[DataFrame] = []
    for k, (name, weight) in enumerate(zip(components, weights, strict=True)):
        f = get(name)
        z = zscore(f.compute(t).where(is_finite(F.col("score"))), "score")
        parts.append(z.where(is_finite(F.col("score"))).select("date", "security_id", F.lit(k).alias("k"), (F.col("score") * f.direction * weight).alias("x"), F.lit(float(weight)).alias("w")))
    # one aggregation over the union stands for a chain of full outer joins
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("date", "security_id").agg(safe_div(F.sum("x"), F.sum("w")).alias("score"))


@factor("composite_value_quality", PIT, PRICES)
def composite_value_quality(t: Tables) -> DataFrame:
    return composite(t, ["value_earnings_yield", "value_book_to_price", "quality_roa"])
