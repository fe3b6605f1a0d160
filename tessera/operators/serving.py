"""Serving queries: screener, fundamentals, per-share figures, dividends, prices, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import latest, safe_div

MAX_TICKERS, MAX_DAYS, MAX_CELLS = 500, 3_700, 200_000


def _on_or_before(df: DataFrame, as_of: str, column: str = "date") -> DataFrame:
    """Rows of the greatest date not after as_of. The date is looked up first, so that the scan behind can be pruned to it."""
    day = df.where(F.col(column) <= F.to_date(F.lit(as_of))).agg(F.max(column)).first()[0]
    return df.where(F.col(column) == F.lit(day)) if day else df.where(F.lit(False))


# Account ids of each metric in order of preference.
METRICS = {
    "revenue": ("ifrs-full_Revenue", "ifrs_Revenue"),
    "operating_profit": ("dart_OperatingIncomeLoss",),
    "net_income": ("ifrs-full_ProfitLossAttributableToOwnersOfParent", "ifrs_ProfitLossAttributableToOwnersOfParent", "ifrs-full_ProfitLoss", "ifrs_ProfitLoss"),
    "assets": ("ifrs-full_Assets", "ifrs_Assets"),
    "liabilities": ("ifrs-full_Liabilities", "ifrs_Liabilities"),
    "equity": ("ifrs-full_EquityAttributableToOwnersOfParent", "ifrs_EquityAttributableToOwnersOfParent", "ifrs-full_Equity", "ifrs_Equity"),
    "cash_and_equivalents": ("ifrs-full_CashAndCashEquivalents", "ifrs_CashAndCashEquivalents"),
    "operating_cash_flow": ("ifrs-full_CashFlowsFromUsedInOperatingActivities", "ifrs_CashFlowsFromUsedInOperatingActivities"),
    "dividends_paid": (
        "ifrs-full_DividendsPaidClassifiedAsFinancingActivities", "ifrs_DividendsPaidClassifiedAsFinancingActivities", "ifrs-full_DividendsPaid", "ifrs_DividendsPaid",
        "dart_AnnualDividendsPaid",
    ),
    "treasury_share_purchase": ("dart_AcquisitionOfTreasuryShares", "ifrs-full_PurchaseOfTreasuryShares", "ifrs_PurchaseOfTreasuryShares"),
    "treasury_share_sale": ("ifrs-full_SaleOrIssueOfTreasuryShares", "dart_DispositionOfTreasuryShares"),
    "treasury_share_cancellation": ("ifrs-full_CancellationOfTreasuryShares",),
    "eps_basic": ("ifrs-full_BasicEarningsLossPerShare", "ifrs_BasicEarningsLossPerShare"),
}
SCREENED = ("revenue", "operating_profit", "net_income", "equity", "liabilities")
CAPITAL_ACTIONS = ("dividends_paid", "treasury_share_purchase", "treasury_share_sale", "treasury_share_cancellation")
BASIC = tuple(m for m in METRICS if m != "eps_basic")
ANNUAL = ("11011", "annual")


def _accounts(metrics: tuple[str, ...]) -> list[str]:
    return [a for m in metrics for a in METRICS[m]]


def with_metric(financials: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Rows of the metrics' accounts with `metric` and `preference` (0 is best); other accounts, however alike in name, go."""
    table = F.create_map(*[x for m in metrics for k, a in enumerate(METRICS[m]) for x in (F.lit(a), F.struct(F.lit(m).alias("metric"), F.lit(k).alias("preference")))])
    known = financials.where(F.col("account_id").isin(_accounts(metrics))).withColumn("_known", table[F.col("account_id")])
    return known.withColumn("metric", F.col("_known.metric")).withColumn("preference", F.col("_known.preference")).drop("_known")


def best_rows(financials: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the newest fiscal year, then the newest filing, consolidated before separate, the preferred account."""
    order = (F.col("fiscal_year").desc_nulls_last(), F.col("available_date").desc_nulls_last(), F.col("is_consolidated").desc_nulls_last(), F.col("preference").asc())
    return latest(financials, keys, *order, F.col("fiscal_period_end").desc_nulls_last(), F.col("rcept_no").desc_nulls_last(), F.col("amount").desc_nulls_last())


def screener(prices: DataFrame, names: DataFrame, financials: DataFrame, dividends: DataFrame, snapshots: DataFrame, as_of: str) -> DataFrame:
    """Equities of the last trading day with PER, PBR, ROE, margin, debt ratio and what they come from; a snapshot's PER and ROE win.

    prices: date, ticker, market, security_type, close_adj, market_cap. The day is picked before anything is joined.
    """
    p = _on_or_before(prices, as_of).where(F.col("market").isin("KOSPI", "KOSDAQ") & (F.col("security_type") == "equity") & F.col("ticker").isNotNull())
    p = p.join(names.select("ticker", "name"), "ticker").where(~F.col("name").like("%리츠%") & ~F.col("name").ilike("%reit%"))
    f = financials.where(F.col("account_id").isin(_accounts(SCREENED)) & (F.col("available_date") <= F.to_date(F.lit(as_of))) & F.col("report_type").isin(*ANNUAL))
    f = latest(f, ["ticker", "account_id"], F.col("available_date").desc(), F.col("fiscal_period_end").desc(), F.col("is_consolidated").desc(), F.col("rcept_no").desc(), F.col("amount").desc_nulls_last())
    f = f.groupBy("ticker").agg(*[F.max(F.when(F.col("account_id").isin(*METRICS[m]), F.col("amount"))).alias(m) for m in SCREENED])
    d = dividends.where(F.col("available_date") <= F.to_date(F.lit(as_of))).groupBy("ticker").agg(F.max("cash_dividend_yield_pct").alias("dividend_yield"))
    s = latest(snapshots, ["ticker"], F.col("snapshot_dt").desc(), F.col("per").desc_nulls_last(), F.col("roe").desc_nulls_last()).select("ticker", F.col("per").alias("_per"), F.col("roe").alias("_roe"))
    j = p.join(f, "ticker", "left").join(d, "ticker", "left").join(s, "ticker", "left")
    cap = F.when(F.col("market_cap") != 0, F.col("market_cap"))
    return j.select(
        "ticker", "name", "market", F.col("close_adj").alias("close"), "market_cap", F.round(F.coalesce("_per", safe_div(cap, F.col("net_income"))), 4).alias("per"),
        F.round(safe_div(cap, F.col("equity")), 4).alias("pbr"), F.round(F.coalesce("_roe", safe_div(F.col("net_income"), F.col("equity")) * 100), 4).alias("roe"),
        F.round(safe_div(F.col("operating_profit"), F.col("revenue")) * 100, 4).alias("operating_margin"), F.round(safe_div(F.col("liabilities"), F.col("equity")) * 100, 4).alias("debt_ratio"),
        "dividend_yield", "revenue", "operating_profit", "net_income", "equity", F.lit(as_of).alias("as_of"),
    )


def basic_fundamentals(financials: DataFrame, as_of: str, metrics: tuple[str, ...] = BASIC) -> DataFrame:
    """Latest annual amount of each metric per security. Equity is assets less liabilities, where these leave more than nothing,
    if it is missing, or neither that of the parent's owners nor within 5 % of the difference."""
    f = financials.where((F.col("available_date") <= F.to_date(F.lit(as_of))) & (F.col("report_type") == "11011"))
    f = best_rows(with_metric(f, metrics), ["security_id", "metric"])
    owners = F.col("account_id").contains("EquityAttributableToOwnersOfParent")
    w = f.groupBy("security_id").agg(*[F.max(F.when(F.col("metric") == m, F.col("amount"))).alias(m) for m in metrics], F.max(F.when(F.col("metric") == "equity", owners)).alias("_owners"))
    if not {"assets", "liabilities", "equity"} <= set(metrics):
        return w.drop("_owners")
    net = F.col("assets") - F.col("liabilities")
    off = F.col("equity").isNull() | (F.abs(F.col("equity") - net) / F.greatest(F.abs(net), F.lit(1.0)) > 0.05)
    repair = (net > 0) & off & ~F.coalesce("_owners", F.lit(False))
    return w.withColumn("equity", F.when(repair, net).otherwise(F.col("equity"))).drop("_owners")


def capital_actions(financials: DataFrame, as_of: str, first_year: int, last_year: int) -> DataFrame:
    """(security_id, fiscal_year, metric, amount): dividends and treasury shares by year, the best row of each."""
    f = financials.where((F.col("available_date") <= F.to_date(F.lit(as_of))) & F.col("fiscal_year").between(first_year, last_year))
    return best_rows(with_metric(f, CAPITAL_ACTIONS), ["security_id", "fiscal_year", "metric"]).select("security_id", "fiscal_year", "metric", "account_id", "amount")


def per_share(financials: DataFrame, shares: DataFrame, as_of: str) -> DataFrame:
    """(security_id, bps, eps_annual, eps_ttm, eps_ttm_reason): per outstanding share; reported basic EPS wins over computed.

    Trailing net income is the latest row's; of an interim one: that, plus the year's before, less the same period's a year before.
    shares: security_id, shares.
    """
    f = financials.where(F.col("available_date") <= F.to_date(F.lit(as_of)))
    annual = F.col("report_type") == "11011"
    equity = basic_fundamentals(financials, as_of, ("assets", "liabilities", "equity")).select("security_id", "equity")
    income = with_metric(f, ("net_income",)).withColumn("month", F.month("fiscal_period_end"))
    year = best_rows(income.where(annual), ["security_id"]).select("security_id", F.col("amount").alias("annual"))
    now = best_rows(income, ["security_id"]).select("security_id", F.col("amount").alias("now"), "report_type", (F.col("fiscal_year") - 1).alias("fiscal_year"), "month")
    # one row per security, year, month and report, and the two that an interim row needs
    periods = best_rows(income, ["security_id", "fiscal_year", "month", "report_type"]).select("security_id", "fiscal_year", "month", "report_type", "amount")
    before = periods.where(annual & (F.col("month") == 12)).select("security_id", "fiscal_year", F.col("amount").alias("before"))
    same = periods.withColumnRenamed("amount", "same")
    ttm = now.join(before, ["security_id", "fiscal_year"], "left").join(same, ["security_id", "fiscal_year", "month", "report_type"], "left")
    ttm = ttm.select("security_id", F.when(annual, F.col("now")).otherwise(F.col("now") + F.col("before") - F.col("same")).alias("ttm"))
    direct = with_metric(f, ("eps_basic",))
    said = best_rows(direct.where(annual), ["security_id"]).select("security_id", F.col("amount").alias("said"))
    newest = best_rows(direct, ["security_id"]).select("security_id", annual.alias("said_now"))
    j = equity.join(year, "security_id", "full_outer").join(ttm, "security_id", "full_outer").join(said, "security_id", "full_outer").join(newest, "security_id", "left").join(shares.select("security_id", "shares"), "security_id", "left")
    over = lambda c: safe_div(F.col(c), F.col("shares").cast("double"))
    eps = F.coalesce(F.when(F.col("said_now"), F.col("said")), over("ttm"))
    reason = F.when(eps.isNotNull(), None).when(F.col("shares").isNull(), "shares unavailable").when(F.col("annual").isNull() & F.col("ttm").isNull(), "net income rows unavailable").otherwise("prior-year rows unavailable")
    return j.select("security_id", over("equity").alias("bps"), F.coalesce("said", over("annual")).alias("eps_annual"), eps.alias("eps_ttm"), reason.alias("eps_ttm_reason"))


def share_denominator(counts: DataFrame, cutoff: str) -> DataFrame:
    """Outstanding shares per issuer: the sum over its classes at the latest period not after the cutoff."""
    c = counts.where(F.col("available_date") <= F.to_date(F.lit(cutoff)))
    last = c.groupBy("issuer_id").agg(F.max("fiscal_year").alias("fiscal_year"))
    return c.join(last, ["issuer_id", "fiscal_year"], "left_semi").groupBy("issuer_id").agg(F.sum("outstanding_shares").cast("long").alias("shares"), F.max("fiscal_year").alias("fiscal_year"))


def eps_ttm(cumulative: DataFrame, shares: DataFrame) -> DataFrame:
    """(latest cumulative + annual of the year before - the same period a year before) / shares.

    cumulative: issuer_id, fiscal_year, quarter 1..4, income so far in the year."""
    c = cumulative.select("issuer_id", "fiscal_year", "quarter", "income")
    now = latest(c, ["issuer_id"], F.col("fiscal_year").desc(), F.col("quarter").desc())
    year = c.where("quarter = 4").select("issuer_id", (F.col("fiscal_year") + 1).alias("fiscal_year"), F.col("income").alias("annual"))
    same = c.select("issuer_id", (F.col("fiscal_year") + 1).alias("fiscal_year"), "quarter", F.col("income").alias("same"))
    j = now.join(year, ["issuer_id", "fiscal_year"], "left").join(same, ["issuer_id", "fiscal_year", "quarter"], "left")
    ttm = F.when(F.col("quarter") == 4, F.col("income")).otherwise(F.col("income") + F.col("annual") - F.col("same"))
    return j.join(shares, "issuer_id", "left").select("issuer_id", j.fiscal_year, "quarter", ttm.alias("net_income_ttm"), safe_div(ttm, F.col("shares").cast("double")).alias("eps_ttm"))


def dividends_as_of(dividends: DataFrame, as_of: str, first_year: int, last_year: int) -> DataFrame:
    d = dividends.where((F.col("available_date") <= F.to_date(F.lit(as_of))) & F.col("fiscal_year").between(first_year, last_year))
    return latest(d, ["security_id", "fiscal_year"], F.col("available_date").desc(), F.col("cash_dividend_per_share").desc_nulls_last())


def holdings_as_of(holdings: DataFrame, as_of: str, top: int) -> DataFrame:
    """The last snapshot not after a date, its `top` largest holdings (a top-k report)."""
    h = _on_or_before(holdings, as_of)
    return h.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(F.col("market_value").desc(), "stock_code"))).where(F.col("rank") <= top)


def close_batch(prices: DataFrame, tickers: list[str], start: str, end: str) -> DataFrame:
    """Closes of some tickers over a range; the request itself is limited, the answer isn't cut."""
    from datetime import date

    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if len(tickers) > MAX_TICKERS or days > MAX_DAYS or days * len(tickers) > MAX_CELLS or days < 1:
        raise ValueError("too large a request")
    return prices.where(F.col("ticker").isin(tickers) & F.col("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).select("ticker", "date", "close_adj", "volume")


def search(names: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Exact ticker or part of a name, by ticker."""
    return names.where((F.col("ticker") == text.strip()) | F.lower("name").contains(text.strip().lower())).orderBy("ticker").limit(limit)


def quotes(snapshots: DataFrame, prices: DataFrame) -> DataFrame:
    """Latest snapshot price per ticker, else the latest stored close."""
    s = latest(snapshots, ["ticker"], F.col("snapshot_dt").desc()).select("ticker", F.col("snapshot_dt").alias("date"), F.col("close").alias("price"), F.lit(0).alias("_p"))
    g = latest(prices, ["ticker"], F.col("date").desc()).select("ticker", "date", F.col("close_adj").alias("price"), F.lit(1).alias("_p"))
    return latest(s.unionByName(g), ["ticker"], F.col("_p")).drop("_p")
