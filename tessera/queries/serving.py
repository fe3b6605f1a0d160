"""Serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import serving as S
from tessera.queries import query

AS_OF = "2000-12-29"
_FIN = f"(SELECT * FROM fin WHERE available_date <= DATE '{AS_OF}' AND report_type = '11011')"


def _snapshots(b):
    return b("nps").select(F.col("stock_code").alias("ticker"), F.col("date").alias("snapshot_dt"), (F.col("market_value") / 10).alias("per"), F.when(F.col("market_value") % 2 == 0, F.col("ownership_pct")).alias("roe"))


@query("screener", "px_dense", "universe", "names", "fin", "divs", "nps", sql=f""", p AS (SELECT x.ticker, n.name, u.market, x.close_adj, x.market_cap FROM px_dense x JOIN universe u ON u.date = x.date AND u.ticker = x.ticker JOIN names n ON n.ticker = x.ticker
    WHERE x.date = (SELECT max(date) FROM px_dense WHERE date <= DATE '{AS_OF}') AND u.security_type = 'equity' AND n.name NOT LIKE '%리츠%' AND n.name NOT ILIKE '%reit%'),
  f AS (SELECT * FROM {_FIN} WHERE account_id IN ('ifrs-full_Revenue', 'dart_OperatingIncomeLoss', 'ifrs-full_ProfitLoss', 'ifrs-full_Equity', 'ifrs-full_Liabilities')
    QUALIFY row_number() OVER (PARTITION BY ticker, account_id ORDER BY available_date DESC, fiscal_period_end DESC, is_consolidated DESC, rcept_no DESC) = 1),
  w AS (SELECT ticker, max(amount) FILTER (account_id LIKE '%Revenue%') AS rev, max(amount) FILTER (account_id = 'dart_OperatingIncomeLoss') AS op, max(amount) FILTER (account_id LIKE '%ProfitLoss%') AS ni,
    max(amount) FILTER (account_id LIKE '%Equity%') AS eq, max(amount) FILTER (account_id LIKE '%Liabilities%') AS li FROM f GROUP BY ticker),
  d AS (SELECT ticker, max(cash_dividend_yield_pct) AS dividend_yield FROM divs WHERE available_date <= DATE '{AS_OF}' GROUP BY ticker),
  s AS (SELECT stock_code AS ticker, market_value / 10 AS per, CASE WHEN market_value % 2 = 0 THEN ownership_pct END AS roe FROM nps QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY date DESC) = 1)
  SELECT p.ticker, p.name, p.market, p.close_adj AS close, p.market_cap, round(coalesce(s.per, nullif(market_cap, 0) / nullif(ni, 0)), 4) AS per, round(nullif(market_cap, 0) / nullif(eq, 0), 4) AS pbr,
  round(coalesce(s.roe, ni / nullif(eq, 0) * 100), 4) AS roe, round(op / nullif(rev, 0) * 100, 4) AS operating_margin, round(li / nullif(eq, 0) * 100, 4) AS debt_ratio, d.dividend_yield,
  rev AS revenue, op AS operating_profit, ni AS net_income, eq AS equity, '{AS_OF}' AS as_of FROM p LEFT JOIN w USING (ticker) LEFT JOIN d USING (ticker) LEFT JOIN s USING (ticker)""")
def _screener(b):
    days = b("universe").where(F.col("date") <= F.to_date(F.lit(AS_OF))).select("date", "ticker", "market", "security_type")
    p = b("px_dense").where(F.col("date") <= F.to_date(F.lit(AS_OF))).select("date", "ticker", "close_adj", "market_cap").join(days, ["date", "ticker"])
    return S.screener(p, b("names"), b("fin"), b("divs"), _snapshots(b), AS_OF)


_BEST = """SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY fiscal_year DESC, available_date DESC, is_consolidated DESC, fiscal_period_end DESC, rcept_no DESC) = 1"""
_BASIC = f""", bf AS (SELECT *, CASE account_id WHEN 'ifrs-full_Equity' THEN 'e' WHEN 'ifrs-full_Liabilities' THEN 'l' WHEN 'ifrs-full_ProfitLoss' THEN 'n' WHEN 'ifrs-full_Revenue' THEN 'r' WHEN 'dart_OperatingIncomeLoss' THEN 'o' WHEN 'ifrs-full_Assets' THEN 'a'
    WHEN 'dart_AcquisitionOfTreasuryShares' THEN 't' WHEN 'ifrs-full_DividendsPaid' THEN 'd' END AS m FROM {_FIN}),
  bg AS ({_BEST.format("bf WHERE m IS NOT NULL", "security_id, m")}),
  bw AS (SELECT security_id, max(amount) FILTER (m = 'r') AS revenue, max(amount) FILTER (m = 'o') AS operating_profit, max(amount) FILTER (m = 'n') AS net_income, max(amount) FILTER (m = 'a') AS assets, max(amount) FILTER (m = 'e') AS eq,
    max(amount) FILTER (m = 'l') AS liabilities, max(amount) FILTER (m = 't') AS treasury_share_purchase, max(amount) FILTER (m = 'd') AS dividends_paid FROM bg GROUP BY security_id),
  basic AS (SELECT security_id, revenue, operating_profit, net_income, assets, liabilities, CASE WHEN assets - liabilities > 0 AND (eq IS NULL OR abs(eq - (assets - liabilities)) / greatest(assets - liabilities, 1) > 0.05) THEN assets - liabilities ELSE eq END AS equity, treasury_share_purchase, dividends_paid FROM bw)"""


@query("basic_fundamentals", "fin", sql=_BASIC + " SELECT * FROM basic")
def _basic(b):
    columns = ("security_id", "revenue", "operating_profit", "net_income", "assets", "liabilities", "equity", "treasury_share_purchase", "dividends_paid")
    return S.basic_fundamentals(b("fin"), AS_OF).select(*columns)  # the other metrics have no rows here


@query("capital_actions", "fin", sql=f""", c AS (SELECT *, CASE account_id WHEN 'dart_AcquisitionOfTreasuryShares' THEN 'treasury_share_purchase' WHEN 'ifrs-full_DividendsPaid' THEN 'dividends_paid' END AS metric FROM fin WHERE available_date <= DATE '{AS_OF}' AND fiscal_year BETWEEN 1994 AND 1999)
  SELECT security_id, fiscal_year, metric, account_id, amount FROM ({_BEST.format("c WHERE metric IS NOT NULL", "security_id, fiscal_year, metric")})""")
def _capital(b):
    return S.capital_actions(b("fin"), AS_OF, 1994, 1999)


_INCOME = f", inc AS (SELECT *, month(fiscal_period_end) AS mo FROM fin WHERE account_id = 'ifrs-full_ProfitLoss' AND available_date <= DATE '{AS_OF}')"


@query("per_share", "fin", "names", sql=_BASIC + _INCOME + f""", yr AS ({_BEST.format("inc WHERE report_type = '11011'", "security_id")}), nw AS ({_BEST.format("inc", "security_id")}),
  pd AS ({_BEST.format("inc", "security_id, fiscal_year, mo, report_type")}), ids AS (SELECT security_id FROM basic WHERE equity IS NOT NULL OR assets IS NOT NULL OR liabilities IS NOT NULL UNION SELECT security_id FROM nw),
  t AS (SELECT nw.security_id, CASE WHEN nw.report_type = '11011' THEN nw.amount ELSE nw.amount + a.amount - s.amount END AS ttm FROM nw LEFT JOIN pd a ON a.security_id = nw.security_id AND a.fiscal_year = nw.fiscal_year - 1 AND a.mo = 12 AND a.report_type = '11011'
    LEFT JOIN pd s ON s.security_id = nw.security_id AND s.fiscal_year = nw.fiscal_year - 1 AND s.mo = nw.mo AND s.report_type = nw.report_type)
  SELECT security_id, round(basic.equity / n, 6) AS bps, round(yr.amount / n, 6) AS eps_annual, round(t.ttm / n, 6) AS eps_ttm,
    CASE WHEN t.ttm / n IS NOT NULL THEN NULL WHEN n IS NULL THEN 'shares unavailable' WHEN yr.amount IS NULL AND t.ttm IS NULL THEN 'net income rows unavailable' ELSE 'prior-year rows unavailable' END AS eps_ttm_reason
  FROM ids LEFT JOIN basic USING (security_id) LEFT JOIN yr USING (security_id) LEFT JOIN t USING (security_id) LEFT JOIN (SELECT security_id, 1000.0 * length(name) AS n FROM names) sh USING (security_id)""")
def _per_share(b):
    shares = b("names").select("security_id", (F.length("name") * 1000).alias("shares"))
    out = S.per_share(b("fin"), shares, AS_OF)
    return out.select("security_id", *[F.round(c, 6).alias(c) for c in ("bps", "eps_annual", "eps_ttm")], "eps_ttm_reason")


def _counts(b):
    d = b("divs")
    return d.select(F.concat(F.lit("I"), "ticker").alias("issuer_id"), "fiscal_year", "available_date", (F.col("o_orderkey") * 10).alias("outstanding_shares"))


_SH = ", c AS (SELECT 'I' || ticker AS issuer_id, fiscal_year, o_orderkey * 10 AS q FROM divs WHERE available_date <= DATE '2000-12-29'), sh AS (SELECT issuer_id, CAST(sum(q) AS BIGINT) AS shares, max(fiscal_year) AS fiscal_year FROM c WHERE (issuer_id, fiscal_year) IN (SELECT issuer_id, max(fiscal_year) FROM c GROUP BY 1) GROUP BY issuer_id)"


@query("share_denominator", "divs", sql=_SH + " SELECT * FROM sh")
def _denominator(b):
    return S.share_denominator(_counts(b), AS_OF)


@query("eps_ttm", "divs", "fin", sql=_SH + """, q AS (SELECT 'I' || ticker AS issuer_id, fiscal_year, CAST(quarter(fiscal_period_end) AS INT) AS quarter, max(amount) AS x FROM fin WHERE account_id = 'ifrs-full_ProfitLoss' GROUP BY ALL),
  l AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY issuer_id ORDER BY fiscal_year DESC, quarter DESC) = 1),
  t AS (SELECT l.issuer_id, l.fiscal_year, l.quarter, CASE WHEN l.quarter = 4 THEN l.x ELSE l.x + a.x - s.x END AS ttm FROM l LEFT JOIN q a ON a.issuer_id = l.issuer_id AND a.fiscal_year = l.fiscal_year - 1 AND a.quarter = 4 LEFT JOIN q s ON s.issuer_id = l.issuer_id AND s.fiscal_year = l.fiscal_year - 1 AND s.quarter = l.quarter)
  SELECT t.issuer_id, t.fiscal_year, t.quarter, round(ttm, 4) AS net_income_ttm, round(ttm / nullif(shares, 0), 6) AS eps_ttm FROM t LEFT JOIN sh USING (issuer_id)""")
def _eps(b):
    c = b("fin").where("account_id = 'ifrs-full_ProfitLoss'").groupBy(F.concat(F.lit("I"), "ticker").alias("issuer_id"), "fiscal_year", F.quarter("fiscal_period_end").alias("quarter")).agg(F.max("amount").alias("income"))
    out = S.eps_ttm(c, S.share_denominator(_counts(b), AS_OF).select("issuer_id", "shares"))
    return out.withColumn("net_income_ttm", F.round("net_income_ttm", 4)).withColumn("eps_ttm", F.round("eps_ttm", 6))


@query("dividends_asof", "divs", sql=f"SELECT security_id, fiscal_year, available_date, cash_dividend_per_share FROM divs WHERE available_date <= DATE '{AS_OF}' AND fiscal_year BETWEEN 1996 AND 1999 QUALIFY row_number() OVER (PARTITION BY security_id, fiscal_year ORDER BY available_date DESC, cash_dividend_per_share DESC) = 1")
def _dividends(b):
    return S.dividends_as_of(b("divs"), AS_OF, 1996, 1999).select("security_id", "fiscal_year", "available_date", "cash_dividend_per_share")


@query("nps_universe_asof", "nps", sql=f"SELECT date, stock_code, market_value, CAST(row_number() OVER (ORDER BY market_value DESC, stock_code) AS INT) AS rank FROM nps WHERE date = (SELECT max(date) FROM nps WHERE date <= DATE '{AS_OF}') QUALIFY rank <= 25")
def _nps(b):
    return S.holdings_as_of(b("nps"), AS_OF, 25).select("date", "stock_code", "market_value", "rank")


@query("close_batch", "px", sql="SELECT ticker, date, close_adj, volume FROM px WHERE ticker IN ('000001', '000003', '000007') AND date BETWEEN DATE '1999-01-01' AND DATE '2000-12-29'")
def _close(b):
    return S.close_batch(b("px"), ["000001", "000003", "000007"], "1999-01-01", AS_OF)


@query("quotes", "px", "nps", sql=", s AS (SELECT stock_code AS ticker, date, market_value AS price, 0 AS p FROM nps WHERE market_value % 2 = 0 QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY date DESC) = 1), g AS (SELECT ticker, date, close_adj AS price, 1 AS p FROM px QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1) SELECT ticker, date, price FROM (SELECT * FROM s UNION ALL SELECT * FROM g) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY p) = 1")
def _quotes(b):
    snap = b("nps").where("market_value % 2 = 0").select(F.col("stock_code").alias("ticker"), F.col("date").alias("snapshot_dt"), F.col("market_value").alias("close"))
    return S.quotes(snap, b("px"))


@query("security_search", "names", sql="SELECT security_id, ticker, name FROM names WHERE ticker = 'corp1' OR contains(lower(name), 'corp1') ORDER BY ticker LIMIT 20")
def _search(b):
    return S.search(b("names"), " Corp1")


@query("analytics_daily_prices", "px", "names", "universe", sql="SELECT p.date, p.security_id, p.ticker, n.name, u.market, u.security_type, p.close_adj, p.volume FROM px p LEFT JOIN names n ON n.security_id = p.security_id LEFT JOIN universe u ON u.date = p.date AND u.security_id = p.security_id")
def _daily(b):
    j = b("px").join(F.broadcast(b("names").select("security_id", "name")), "security_id", "left").join(b("universe").select("date", "security_id", "market", "security_type"), ["date", "security_id"], "left")
    return j.select("date", "security_id", "ticker", "name", "market", "security_type", "close_adj", "volume")


@query("sql_sandbox", sql="SELECT c_mktsegment, count(*) AS n, CAST(floor(max(c_acctbal)) AS BIGINT) AS top FROM customer WHERE c_mktsegment <> 'drop table; --' GROUP BY c_mktsegment")
def _sandbox(b):
    from tessera.sources.sandbox import Sandbox

    box = Sandbox(b.spark, {"customer"})
    return box.plan("SELECT c_mktsegment, count(*) AS n, CAST(floor(max(c_acctbal)) AS BIGINT) AS top FROM customer WHERE c_mktsegment <> 'drop table; --' GROUP BY c_mktsegment -- by segment")
