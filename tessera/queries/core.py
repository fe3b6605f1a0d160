"""Factors, cross-section, analytics, backtest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import analysis as A
from tessera.operators import backtest as BT
from tessera.operators import cross_section as X
from tessera.operators import factors as FA
from tessera.operators.calendar import day_axis, month_ends
from tessera.plans.bridge import filled_on, quotes, universe_on
from tessera.queries import query

R6 = lambda c: F.round(c, 6)
DIV_SQL = "(SELECT * FROM divs QUALIFY row_number() OVER (PARTITION BY security_id, available_date ORDER BY fiscal_period_end DESC, cash_dividend_per_share DESC) = 1)"
#: Every trading day sees the best statement available strictly before it; filtered to the accounts that a query reads.
PIT_SQL = """, pit AS (
  SELECT m.date AS as_of_date, f.security_id, f.account_id, f.amount, f.report_type FROM axis m JOIN fin f ON f.available_date < m.date WHERE {0}
  QUALIFY row_number() OVER (PARTITION BY m.date, f.security_id, f.report_type = '11011', f.account_id ORDER BY f.fiscal_period_end DESC, f.report_type DESC, f.available_date DESC, f.is_consolidated DESC, f.rcept_no DESC) = 1)"""


def _pit(b) -> DataFrame:
    from tessera.plans.fundamentals import pit_intervals

    return pit_intervals(b("fin"), b("axis").select(F.col("date").alias("as_of_date")))


def _tables(b) -> dict[str, DataFrame]:
    from tessera.plans.filings import filing_events
    from tessera.plans.holdings import holdings_delta
    from tessera.plans.prices import preferred_discount

    class Lazy(dict):
        def __missing__(self, key):
            self[key] = {
                FA.PRICES: lambda: b("px_dense"),
                FA.PIT: lambda: _pit(b),
                "silver.dividends": lambda: b("divs"),
                "gold.nps_holdings_delta": lambda: holdings_delta(b("nps").withColumn("listing_id", F.lit(None).cast("string"))),
                "gold.filing_events": lambda: filing_events(b("filings")),
                "gold.preferred_discount": lambda: preferred_discount(b("px").select("date", "security_id", F.col("close_adj").alias("close")), _pairs(b)),
            }[key]()
            return self[key]

    return Lazy()


def _pairs(b) -> DataFrame:
    from tessera.plans.identity import preferred_relations

    return preferred_relations(b("names"))


def _factor(name: str, *needs: str, sql: str) -> None:
    @query(f"factor_{name}", *needs, sql=sql)
    def run(b) -> DataFrame:
        return FA.get(name).compute(_tables(b)).select("date", "security_id", R6(F.col("score")).alias("score"))


_W = "(PARTITION BY security_id ORDER BY date)"
_factor("momentum_12_1", "px_dense", sql=f"SELECT date, security_id, round((close_adj / lag(close_adj, 252) OVER {_W}) / (close_adj / lag(close_adj, 21) OVER {_W}) - 1, 6) AS score FROM px_dense")
_factor("reversal_1m", "px_dense", sql=f"SELECT date, security_id, round(close_adj / lag(close_adj, 21) OVER {_W} - 1, 6) AS score FROM px_dense")
_R = "(PARTITION BY security_id ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
_factor("momentum_52w_high", "px_dense", sql=f"SELECT date, security_id, round(CASE WHEN count(*) OVER {_R} >= 200 THEN close_adj / max(close_adj) OVER {_R} END, 6) AS score FROM px_dense")
_factor("lowvol_252", "px_dense", sql=f"SELECT date, security_id, round(CASE WHEN count(return_1d) OVER {_R} >= 200 THEN stddev_samp(return_1d) OVER {_R} END, 6) AS score FROM px_dense")


def _ratio(account: str) -> str:
    return PIT_SQL.format(f"account_id = '{account}' AND report_type = '11011'") + f" SELECT p.as_of_date AS date, p.security_id, round(p.amount / x.market_cap, 6) AS score FROM pit p JOIN px_dense x ON x.date = p.as_of_date AND x.security_id = p.security_id WHERE p.account_id = '{account}' AND p.report_type = '11011' AND x.market_cap > 0"


_factor("value_earnings_yield", "axis", "fin", "px_dense", sql=_ratio("ifrs-full_ProfitLoss"))
_factor("value_book_to_price", "axis", "fin", "px_dense", sql=_ratio("ifrs-full_Equity"))
_PIVOT = PIT_SQL.replace("{0}", "account_id IN ({0}) AND report_type = '11011'") + ", wide AS (SELECT as_of_date AS date, security_id, max(CASE WHEN account_id = 'ifrs-full_ProfitLoss' THEN amount END) AS income, max(CASE WHEN account_id = 'ifrs-full_Assets' THEN amount END) AS assets, max(CASE WHEN account_id = 'ifrs-full_Revenue' THEN amount END) AS revenue FROM pit WHERE report_type = '11011' AND account_id IN ({0}) GROUP BY ALL)"
_factor("quality_roa", "axis", "fin", sql=_PIVOT.format("'ifrs-full_ProfitLoss', 'ifrs-full_Assets'") + " SELECT date, security_id, round(income / assets, 6) AS score FROM wide")
_factor("quality_gpa", "axis", "fin", sql=_PIVOT.format("'ifrs-full_Revenue', 'ifrs-full_Assets'") + " SELECT date, security_id, CAST(NULL AS DOUBLE) AS score FROM wide")
_factor("quality_accruals", "axis", "fin", sql=_PIVOT.format("'ifrs-full_ProfitLoss', 'ifrs-full_Assets'") + " SELECT date, security_id, CAST(NULL AS DOUBLE) AS score FROM wide")
_factor("value_dividend_yield", "divs", "px_dense", sql=f", d AS (SELECT security_id, CAST(available_date + INTERVAL 1 DAY AS DATE) AS eff, cash_dividend_per_share AS dps FROM {DIV_SQL}) SELECT x.date, x.security_id, round(CASE WHEN x.date - d.eff <= 430 THEN d.dps * x.listed_shares / x.market_cap END, 6) AS score FROM px_dense x ASOF LEFT JOIN d ON d.security_id = x.security_id AND d.eff <= x.date")
DELTA_SQL = """, snaps AS (SELECT date, lag(date) OVER (ORDER BY date) AS prev FROM (SELECT DISTINCT date FROM nps)),
  cur AS (SELECT s.date, s.prev, n.security_id, n.ownership_pct FROM snaps s JOIN nps n USING (date) WHERE s.prev IS NOT NULL),
  old AS (SELECT s.date, s.prev, n.security_id, n.ownership_pct FROM snaps s JOIN nps n ON n.date = s.prev),
  delta AS (SELECT coalesce(c.date, o.date) AS date, coalesce(c.prev, o.prev) AS previous_date, coalesce(c.security_id, o.security_id) AS security_id, coalesce(c.ownership_pct, 0) - coalesce(o.ownership_pct, 0) AS delta_ratio,
    o.security_id IS NULL AS entered, c.security_id IS NULL AS exited FROM cur c FULL JOIN old o ON c.date = o.date AND c.security_id = o.security_id)"""
_factor("nps_flow", "nps", "px_dense", sql=DELTA_SQL + ", d AS (SELECT security_id, CAST(date + INTERVAL 8 DAY AS DATE) AS eff, delta_ratio FROM delta) SELECT x.date, x.security_id, round(CASE WHEN x.date - d.eff <= 370 THEN d.delta_ratio END, 6) AS score FROM px_dense x ASOF LEFT JOIN d ON d.security_id = x.security_id AND d.eff <= x.date")
EVENTS_SQL = r""", ev0 AS (SELECT *, trim(regexp_replace(report_nm, '^(?:\s*\[[^\]]*\]\s*)+', '')) AS bare, is_correction OR regexp_matches(report_nm, '\[[^\]]*정정[^\]]*\]') AS corr FROM filings),
  ev1 AS (SELECT *, CASE WHEN regexp_matches(bare, '자기주식\s*처분') THEN 'buyback_disposal' WHEN regexp_matches(bare, '자기주식\s*취득\s*결정') THEN 'buyback' WHEN regexp_matches(bare, '자기주식\s*취득\s*신탁계약\s*체결') THEN 'buyback'
    WHEN regexp_matches(bare, '유상증자\s*결정') THEN 'rights_issue' WHEN regexp_matches(bare, '무상증자\s*결정') THEN 'bonus_issue' WHEN regexp_matches(bare, '(전환사채|신주인수권부사채|교환사채).{0,8}발행\s*결정') THEN 'convertible_bond'
    WHEN regexp_matches(bare, '감자\s*결정') THEN 'capital_reduction' WHEN regexp_matches(bare, '주식\s*분할\s*결정') THEN 'stock_split' WHEN regexp_matches(bare, '주식\s*병합\s*결정') THEN 'stock_merge' WHEN regexp_matches(bare, '(합병|분할)\s*결정') THEN 'merger'
    WHEN regexp_matches(bare, '(현금|현물).{0,4}배당\s*결정') THEN 'dividend' WHEN regexp_matches(bare, '최대주주\s*변경') THEN 'major_holder_change' WHEN regexp_matches(bare, '(단일판매|공급계약).{0,10}체결') THEN 'supply_contract'
    WHEN regexp_matches(bare, '횡령|배임') THEN 'embezzlement' WHEN regexp_matches(bare, '관리종목|상장폐지|감사의견') THEN 'delisting_risk' END AS event_type FROM ev0),
  ev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY security_id, event_type ORDER BY rcept_dt, rcept_no) AS k FROM ev1 WHERE event_type IS NOT NULL) WHERE NOT corr OR k = 1)"""
_factor("event_buyback", "filings", "px_dense", sql=EVENTS_SQL + ", d AS (SELECT DISTINCT security_id, available_date, CAST(available_date + INTERVAL 1 DAY AS DATE) AS eff FROM ev WHERE event_type = 'buyback') SELECT x.date, x.security_id, round(CASE WHEN x.date - d.eff <= 91 THEN exp(-(x.date - d.available_date) / 21.0) END, 6) AS score FROM px_dense x ASOF LEFT JOIN d ON d.security_id = x.security_id AND d.eff <= x.date")
DISCOUNT_SQL = """, pairs AS (SELECT p.security_id AS pref, c.security_id AS com FROM names p JOIN names c ON substr(p.ticker, 1, 5) = substr(c.ticker, 1, 5) WHERE substr(c.ticker, 6, 1) = '0' AND regexp_matches(p.ticker, '^[0-9]{5}[1-9A-Z]$')
    AND regexp_matches(p.name, '([0-9]+)?우[A-Z]?$|우선')),
  disc AS (SELECT a.date, pref, com, 1 - a.close_adj / b.close_adj AS discount FROM pairs JOIN px a ON a.security_id = pref JOIN px b ON b.security_id = com AND b.date = a.date),
  stat AS (SELECT *, count(*) OVER w AS n, avg(discount) OVER w AS mu, stddev_samp(discount) OVER w AS sd FROM disc WINDOW w AS (PARTITION BY pref, com ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)),
  pd AS (SELECT date, pref AS preferred_security_id, com AS common_security_id, discount, CASE WHEN n >= 120 THEN mu END AS discount_mean, CASE WHEN n >= 120 THEN sd END AS discount_std, CASE WHEN n >= 120 AND sd > 0 THEN (discount - mu) / sd END AS discount_z FROM stat)"""
_factor("preferred_discount_z", "names", "px", sql=DISCOUNT_SQL + " SELECT date, preferred_security_id AS security_id, round(discount_z, 6) AS score FROM pd")
_factor("composite_value_quality", "axis", "fin", "px_dense", sql=PIT_SQL.format("account_id IN ('ifrs-full_ProfitLoss', 'ifrs-full_Equity', 'ifrs-full_Assets') AND report_type = '11011'") + """, r AS (
  SELECT p.as_of_date AS date, p.security_id, p.account_id AS c, p.amount / x.market_cap AS v FROM pit p JOIN px_dense x ON x.date = p.as_of_date AND x.security_id = p.security_id WHERE p.report_type = '11011' AND p.account_id IN ('ifrs-full_ProfitLoss', 'ifrs-full_Equity')
  UNION ALL SELECT as_of_date, security_id, 'roa', max(CASE WHEN account_id = 'ifrs-full_ProfitLoss' THEN amount END) / max(CASE WHEN account_id = 'ifrs-full_Assets' THEN amount END) FROM pit WHERE report_type = '11011' GROUP BY as_of_date, security_id),
  z AS (SELECT date, security_id, (v - avg(v) OVER w) / nullif(stddev_samp(v) OVER w, 0) AS z FROM r WHERE v IS NOT NULL WINDOW w AS (PARTITION BY date, c))
  SELECT date, security_id, round(avg(z), 6) AS score FROM z WHERE z IS NOT NULL GROUP BY date, security_id""")

_MOM = f", s0 AS (SELECT date, security_id, close_adj / lag(close_adj, 21) OVER {_W} - 1 AS score FROM px_dense), s AS (SELECT * FROM s0 WHERE score IS NOT NULL)"


def _scores(b) -> DataFrame:
    return FA.reversal_1m({FA.PRICES: b("px_dense")}).where("score IS NOT NULL")


@query("winsorize", "px_dense", sql=_MOM + " SELECT date, security_id, round(greatest(least(score, quantile_cont(score, 0.95) OVER (PARTITION BY date)), quantile_cont(score, 0.05) OVER (PARTITION BY date)), 6) AS score FROM s")
def _winsorize(b):
    return X.winsorize(_scores(b), "score", 0.05, 0.95).select("date", "security_id", R6("score").alias("score"))


@query("zscore", "px_dense", sql=_MOM + " SELECT date, security_id, round((score - avg(score) OVER w) / nullif(stddev_samp(score) OVER w, 0), 6) AS score FROM s WINDOW w AS (PARTITION BY date)")
def _zscore(b):
    return X.zscore(_scores(b), "score").select("date", "security_id", R6("score").alias("score"))


_RANK = "(rank() OVER (PARTITION BY date ORDER BY score) + (count(*) OVER (PARTITION BY date, score) - 1) / 2.0)"


@query("rank_pct", "px_dense", sql=_MOM + f" SELECT date, security_id, round({_RANK} / count(*) OVER (PARTITION BY date), 6) AS score FROM s")
def _rank_pct(b):
    return X.rank_pct(_scores(b), "score").select("date", "security_id", R6("score").alias("score"))


@query("neutralize", "px_dense", "universe", sql=_MOM + " SELECT s.date, s.security_id, round(score - avg(score) OVER (PARTITION BY s.date, market), 6) AS score FROM s JOIN universe u ON u.date = s.date AND u.security_id = s.security_id")
def _neutralize(b):
    return X.neutralize(_scores(b).join(b("universe").select("date", "security_id", "market"), ["date", "security_id"]), "score", ["market"]).select("date", "security_id", R6("score").alias("score"))


@query("quantile_bucket", "px_dense", sql=_MOM + f" SELECT date, security_id, CAST(floor(({_RANK} - 1) * 5 / count(*) OVER (PARTITION BY date)) AS INT) AS bucket FROM s")
def _bucket(b):
    return X.quantile_bucket(_scores(b), "score", 5).select("date", "security_id", "bucket")


@query("size_bucket", "px_dense", sql=", s AS (SELECT date, security_id, market_cap AS score FROM px_dense)" + f" SELECT date, security_id, CAST(floor(({_RANK} - 1) * 5 / count(*) OVER (PARTITION BY date)) AS INT) AS bucket FROM s")
def _size(b):
    return X.size_bucket(b("px_dense")).select("date", "security_id", "bucket")


@query("forward_returns", "px_dense", sql="SELECT date, security_id, round(lead(close_adj, 5) OVER (PARTITION BY security_id ORDER BY date) / close_adj - 1, 6) AS forward_return FROM px_dense")
def _forward(b):
    return A.forward_returns(b("px_dense"), 5).withColumn("forward_return", R6("forward_return"))


_FWD = ", f AS (SELECT date, security_id, lead(close_adj, 5) OVER (PARTITION BY security_id ORDER BY date) / close_adj - 1 AS fr FROM px_dense), j AS (SELECT s.date, s.security_id, score, fr FROM s JOIN f ON f.date = s.date AND f.security_id = s.security_id WHERE fr IS NOT NULL)"


def _fwd(b):
    return A.forward_returns(b("px_dense"), 5)


@query("ic_spearman", "px_dense", sql=_MOM + _FWD + f", k AS (SELECT date, {_RANK} AS a, rank() OVER (PARTITION BY date ORDER BY fr) + (count(*) OVER (PARTITION BY date, fr) - 1) / 2.0 AS c FROM j) SELECT date, round(corr(a, c), 6) AS ic, count(*) AS n FROM k GROUP BY date")
def _ic_s(b):
    return A.information_coefficient(_scores(b), _fwd(b)).withColumn("ic", R6("ic"))


@query("ic_pearson", "px_dense", sql=_MOM + _FWD + " SELECT date, round(corr(score, fr), 6) AS ic, count(*) AS n FROM j GROUP BY date")
def _ic_p(b):
    return A.information_coefficient(_scores(b), _fwd(b), "pearson").withColumn("ic", R6("ic"))


@query("quantile_returns", "px_dense", sql=_MOM + _FWD + f", k AS (SELECT date, fr, CAST(floor(({_RANK} - 1) * 5 / count(*) OVER (PARTITION BY date)) + 1 AS INT) AS quantile FROM j) SELECT date, quantile, round(avg(fr), 6) + 0.0 AS mean_return, count(*) AS n FROM k GROUP BY date, quantile")
def _qr(b):
    return A.quantile_returns(_scores(b), _fwd(b)).withColumn("mean_return", R6("mean_return") + F.lit(0.0))  # no negative zero


@query("factor_turnover", "px_dense", sql=_MOM + """, top AS (SELECT * FROM (SELECT date, security_id, row_number() OVER (PARTITION BY date ORDER BY score DESC, security_id) AS r, count(*) OVER (PARTITION BY date) AS n FROM s) WHERE r <= greatest(1, ceil(n * 0.1))),
  d AS (SELECT date, lag(date) OVER (ORDER BY date) AS previous FROM (SELECT DISTINCT date FROM top))
  SELECT t.date, CASE WHEN any_value(d.previous) IS NOT NULL THEN round(count(p.security_id) / count(*), 6) END AS overlap, count(*) AS n FROM top t JOIN d ON d.date = t.date LEFT JOIN top p ON p.date = d.previous AND p.security_id = t.security_id GROUP BY t.date""")
def _turnover(b):
    return A.factor_turnover(_scores(b)).withColumn("overlap", R6("overlap"))


@query("trading_calendar_month_ends", "axis", sql="SELECT max(date) AS date, max(day_index) AS day_index FROM axis WHERE date BETWEEN DATE '1996-02-01' AND DATE '2001-06-15' GROUP BY year(date), month(date)")
def _month_ends(b):
    return month_ends(day_axis(b("px")), "1996-02-01", "2001-06-15")


CONFIG = BT.BacktestConfig("1996-02-01", "2001-06-29", missing_return=-0.3, charge_final_liquidation=True)


def _backtest(b) -> BT.BacktestResult:
    factor, axis = FA.get("momentum_12_1"), b("axis")
    signals = axis.join(F.broadcast(BT.schedules(axis, CONFIG).select(F.col("signal_date").alias("date")).distinct()), "date", "left_semi")
    scores = FA.momentum_on(signals, lambda days: filled_on(b, days))
    return BT.run(scores, universe_on(b, signals), quotes(b), CONFIG, factor.direction, BT.KoreanCosts(), axis, b.keep)


BT_SQL = f""", mom AS (SELECT date, security_id, (close_adj / lag(close_adj, 252) OVER {_W}) / (close_adj / lag(close_adj, 21) OVER {_W}) - 1 AS score FROM px_dense),
  me AS (SELECT max(day_index) AS i FROM axis WHERE date BETWEEN DATE '1996-02-01' AND DATE '2001-06-29' GROUP BY year(date), month(date)),
  sch0 AS (SELECT sg.date AS signal_date, en.date AS entry_date FROM me JOIN axis sg ON sg.day_index = me.i - 1 JOIN axis en ON en.day_index = me.i WHERE en.date BETWEEN DATE '1996-02-01' AND DATE '2001-06-29'),
  sch AS (SELECT row_number() OVER (ORDER BY entry_date) AS k, signal_date, entry_date, coalesce(lead(entry_date) OVER (ORDER BY entry_date), DATE '2001-06-29') AS exit_date FROM sch0),
  cand AS (SELECT sch.*, m.security_id, row_number() OVER (PARTITION BY sch.k ORDER BY score DESC, m.security_id) AS r, count(*) OVER (PARTITION BY sch.k) AS n FROM sch JOIN mom m ON m.date = sch.signal_date AND m.score IS NOT NULL
    JOIN universe u ON u.date = sch.signal_date AND u.security_id = m.security_id WHERE u.is_active AND u.share_class = 'common' AND NOT u.is_spac_pre AND NOT u.is_halted),
  tgt AS (SELECT k, signal_date, entry_date, exit_date, security_id, least(0.2, 1.0 / greatest(1, ceil(n * 0.1))) AS weight FROM cand WHERE r <= greatest(1, ceil(n * 0.1))),
  pos AS (SELECT a.date, t.security_id, t.weight, t.k, t.signal_date, t.entry_date FROM tgt t JOIN axis a ON a.date > t.entry_date AND a.date <= t.exit_date),
  mv AS (SELECT coalesce(a.k, o.k + 1) AS k, coalesce(a.weight, 0) - coalesce(o.weight, 0) AS d, a.weight FROM tgt a FULL JOIN tgt o ON o.k + 1 = a.k AND o.security_id = a.security_id),
  led AS (SELECT sch.k, sch.signal_date, sch.entry_date, sch.exit_date, count(mv.weight) AS selected_count, coalesce(sum(greatest(d, 0)), 0) AS buys, coalesce(sum(greatest(-d, 0)), 0) AS sells FROM sch LEFT JOIN mv USING (k) GROUP BY ALL),
  gross AS (SELECT p.date, sum(p.weight * coalesce(x.return_1d, -0.3)) AS g FROM pos p LEFT JOIN px_dense x ON x.date = p.date AND x.security_id = p.security_id GROUP BY p.date),
  cost0 AS (SELECT entry_date AS date, (buys + sells) * 0.0005 + sells * 0.0015 AS c FROM led UNION ALL SELECT (SELECT max(date) FROM axis WHERE date <= DATE '2001-06-29'), sum(weight) * 0.002 FROM tgt WHERE k = (SELECT max(k) FROM tgt)),
  cost AS (SELECT date, sum(c) AS c FROM cost0 GROUP BY date),
  curve AS (SELECT a.date, coalesce(g, 0) AS gross_return, coalesce(c, 0) AS cost, product(1 + coalesce(g, 0) - coalesce(c, 0)) OVER (ORDER BY a.date) AS nav FROM axis a LEFT JOIN gross USING (date) LEFT JOIN cost USING (date) WHERE a.date BETWEEN DATE '1996-02-01' AND DATE '2001-06-29')"""


@query("backtest_positions", "px_dense", "universe", sql=BT_SQL + " SELECT date, security_id, round(weight, 6) AS weight, signal_date, entry_date FROM pos")
def _positions(b):
    return _backtest(b).positions.select("date", "security_id", R6("weight").alias("weight"), "signal_date", "entry_date")


@query("backtest_ledger", "px_dense", "universe", sql=BT_SQL + " SELECT signal_date, entry_date, exit_date, selected_count, round(buys + sells, 6) AS turnover, round((buys + sells) * 0.0005 + sells * 0.0015, 6) AS entry_cost, CAST(0 AS BIGINT) AS missing_positions FROM led")
def _ledger(b):
    return _backtest(b).ledger.select("signal_date", "entry_date", "exit_date", "selected_count", R6("turnover").alias("turnover"), R6("entry_cost").alias("entry_cost"), "missing_positions")


@query("backtest_nav", "px_dense", "universe", sql=BT_SQL + " SELECT date, round(gross_return, 6) AS gross_return, round(cost, 6) AS cost, round(nav, 6) AS nav FROM curve")
def _nav(b):
    return _backtest(b).nav.select("date", R6("gross_return").alias("gross_return"), R6("cost").alias("cost"), R6("nav").alias("nav"))


@query("backtest_summary", "px_dense", "universe", sql=BT_SQL + """, dd AS (SELECT *, nav / greatest(1, max(nav) OVER (ORDER BY date)) - 1 AS drawdown FROM curve)
  SELECT round(arg_max(nav, date) - 1, 6) AS total_return, round(product(1 + gross_return), 6) AS gross_growth, round(sum(cost), 6) AS cost_drag, round(min(drawdown), 6) AS max_drawdown, count(*) AS days,
  (SELECT round(avg(buys + sells), 6) FROM led) AS average_turnover, (SELECT count(*) FROM led) AS rebalances FROM dd""")
def _summary(b):
    r = _backtest(b)
    s = BT.summary(r.nav, r.ledger)
    return s.select(*[R6(c).alias(c) if c not in ("days", "rebalances") else F.col(c) for c in s.columns])
