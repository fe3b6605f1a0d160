"""Data quality, audits, research tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import backtest as BT
from tessera.operators import quality as Q
from tessera.queries import query
from tessera.queries.core import BT_SQL, DISCOUNT_SQL, R6, _backtest


def _ohlc(b):
    p = b.table("lineitem").select(F.to_date("l_shipdate").alias("date"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("security_id"), F.col("l_quantity").alias("open"), (F.col("l_quantity") + F.col("l_linenumber") - 2).alias("high"), (F.col("l_quantity") - F.col("l_linenumber") + 2).alias("low"), F.col("l_quantity").alias("close"))
    return p


@query("dq_checks", "px", sql=""", t AS (SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS s, l_quantity AS c, l_quantity + l_linenumber - 2 AS h, l_quantity - l_linenumber + 2 AS l FROM lineitem),
  r AS (SELECT abs(close_adj / lag(close_adj) OVER (PARTITION BY security_id ORDER BY date) - 1) AS r FROM px)
  SELECT 'price_rows' AS check_name, count(*) AS n_rows FROM t UNION ALL SELECT 'ohlc_violations', count(*) FROM t WHERE h < greatest(c, l) OR l > least(c, h) UNION ALL SELECT 'duplicate_keys', CAST((SELECT count(*) FROM t) - count(*) AS BIGINT) FROM (SELECT DISTINCT date, s FROM t)
  UNION ALL SELECT 'unknown_identity', count(*) FROM t WHERE s % 7 = 0 UNION ALL SELECT 'large_returns', count(*) FROM r WHERE r > 0.1""")
def _checks(b):
    p = _ohlc(b)
    known = p.select("security_id").distinct().where(F.substring("security_id", 2, 20).cast("long") % 7 != 0)
    # row checks are on raw lines, the return check on daily closes, where days are unique
    lines = Q.price_checks(p, known).where("check_name <> 'large_returns'")
    daily = b("px").select("date", "security_id", *[F.col("close_adj").alias(c) for c in ("open", "high", "low", "close")])
    return lines.unionByName(Q.price_checks(daily, known, 0.1).where("check_name = 'large_returns'"))


@query("source_mismatch", "raw_prices", sql="SELECT date, ticker, max(close) FILTER (source = 'krx') AS krx, max(close) FILTER (source = 'pre2010') AS pre2010 FROM raw_prices WHERE source IN ('krx', 'pre2010') GROUP BY date, ticker HAVING abs(max(close) FILTER (source = 'krx') / max(close) FILTER (source = 'pre2010') - 1) > 0.009")
def _mismatch(b):
    return Q.source_mismatch(b("raw_prices"), "krx", "pre2010", 0.009)


_PART = ", part AS (SELECT 'prices' AS dataset, date, count(*) AS rows FROM px GROUP BY date UNION ALL SELECT 'filings', rcept_dt, count(*) FROM filings GROUP BY rcept_dt UNION ALL SELECT 'dividends', available_date, count(*) FROM divs GROUP BY available_date)"


def _partitions(b):
    count = lambda df, name, day: df.groupBy(F.col(day).alias("date")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "date", "rows")
    return count(b("px"), "prices", "date").unionByName(count(b("filings"), "filings", "rcept_dt")).unionByName(count(b("divs"), "dividends", "available_date"))


@query("dq_scorecard", "px", "axis", "filings", "divs", sql=_PART + """, k AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY date DESC) AS k FROM part QUALIFY k <= 21), g AS (SELECT dataset, max(date) AS last_date, max(rows) FILTER (k = 1) AS rows, list_sort(list(rows) FILTER (k > 1)) AS old FROM k GROUP BY dataset),
  h AS (SELECT g.dataset, last_date, (SELECT max(day_index) FROM axis) - a.day_index AS age_days, rows, old[len(old) // 2 + 1] AS typical_rows FROM g LEFT JOIN axis a ON a.date = last_date)
  SELECT *, CASE greatest(CASE WHEN age_days > 15 THEN 2 WHEN age_days > 5 THEN 1 ELSE 0 END, CASE WHEN rows < 0.1 * typical_rows THEN 2 WHEN rows < 0.5 * typical_rows THEN 1 ELSE 0 END) WHEN 2 THEN 'F' WHEN 1 THEN 'C' ELSE 'A' END AS grade FROM h""")
def _scorecard(b):
    return Q.scorecard(_partitions(b), b("axis"), 5).select("dataset", "last_date", "age_days", "rows", "typical_rows", "grade")


@query("row_count_gate", "px", sql=", p AS (SELECT date, count(*) AS rows FROM px GROUP BY date), q AS (SELECT *, lag(rows) OVER (ORDER BY date) AS previous_rows FROM p) SELECT date, rows, previous_rows, NOT coalesce(previous_rows >= 10 AND rows < floor(previous_rows * 0.95), FALSE) AS ok FROM q")
def _gate(b):
    return Q.row_count_gate(b("px").groupBy("date").agg(F.count("*").alias("rows")), least=10)


@query("fraud_checks", "px_dense", "universe", "names", sql=BT_SQL + " SELECT t.signal_date, count(*) AS n, count(*) < 30 AS tiny_universe, CAST(count(*) FILTER (n.name LIKE '%스팩%') AS BIGINT) AS spac_names, CAST(count(*) FILTER (x.close_adj < 105) AS BIGINT) AS penny_names FROM tgt t LEFT JOIN names n ON n.security_id = t.security_id LEFT JOIN px_dense x ON x.date = t.signal_date AND x.security_id = t.security_id GROUP BY t.signal_date")
def _fraud(b):
    held = _backtest(b).targets.select("signal_date", "security_id")
    return Q.fraud_checks(held, b("names"), b("px_dense").select("date", "security_id", F.col("close_adj").alias("close")), 30, 105.0)


_JUMP = ", j AS (SELECT date, security_id, lag(close_adj) OVER (PARTITION BY security_id ORDER BY date) AS previous_close, close_adj, return_1d FROM px_dense QUALIFY abs(return_1d) >= 0.1)"


@query("price_jump_audit", "px_dense", sql=_JUMP + " SELECT date, security_id, previous_close, close_adj, round(return_1d, 6) AS return_1d FROM j")
def _audit(b):
    return Q.jump_audit(b("px_dense"), 0.1).withColumn("return_1d", R6("return_1d"))


@query("price_jump_clusters", "px_dense", sql=_JUMP + " SELECT date, count(*) AS n, string_agg(security_id, '|' ORDER BY security_id) AS securities FROM j GROUP BY date")
def _clusters(b):
    return Q.jump_clusters(Q.jump_audit(b("px_dense"), 0.1))


@query("quarantine_returns", "px_dense", sql="SELECT date, security_id, CASE WHEN abs(return_1d) >= 0.1 THEN NULL ELSE round(return_1d, 6) END AS return_1d FROM px_dense")
def _quarantine(b):
    p = b("px_dense").select("date", "security_id", "close_adj", "return_1d")
    return Q.quarantine(p, Q.jump_audit(p, 0.1)).select("date", "security_id", R6("return_1d").alias("return_1d"))


@query("repair_rows", "px", sql="SELECT date, security_id, CASE WHEN num % 4 = 0 THEN close_adj * 2 ELSE close_adj END AS close_adj FROM px")
def _repair(b):
    p = b("px").select("date", "security_id", "close_adj")
    fresh = b("px").where("num % 4 = 0").select("date", "security_id", (F.col("close_adj") * 2).alias("close_adj"))
    return Q.repair(p, fresh, ["date", "security_id"])


@query("shadow_compare", "nps", sql=", a AS (SELECT date, stock_code, market_value FROM nps WHERE market_value % 5 <> 0), z AS (SELECT date, stock_code, CASE WHEN market_value % 7 = 0 THEN -1 ELSE market_value END AS v FROM nps WHERE market_value % 3 <> 0) SELECT CASE WHEN z.date IS NULL THEN 'missing' WHEN a.date IS NULL THEN 'extra' WHEN z.v = a.market_value THEN 'equal' ELSE 'changed' END AS status, count(*) AS n FROM a FULL JOIN z ON a.date = z.date AND a.stock_code = z.stock_code GROUP BY 1")
def _shadow(b):
    n = b("nps")
    a = n.where("market_value % 5 <> 0")
    z = n.where("market_value % 3 <> 0").withColumn("market_value", F.when(F.col("market_value") % 7 == 0, -1.0).otherwise(F.col("market_value")))
    return Q.shadow_compare(a, z, ["date", "stock_code"], "market_value")


@query("removal_impact", "px_dense", sql=""", y AS (SELECT year(date) AS year, security_id, num, arg_min(close_adj, date) * num AS s, arg_max(close_adj, date) * num AS e FROM px_dense GROUP BY year(date), security_id, num), t AS (SELECT *, sum(s) OVER w AS ts, sum(e) OVER w AS te FROM y WINDOW w AS (PARTITION BY year)),
  i AS (SELECT *, te / ts - 1 AS r, (te - e) / nullif(ts - s, 0) - 1 AS x FROM t) SELECT CAST(year AS INT) AS year, security_id, round(r, 6) AS index_return, round(x, 6) AS return_without, round(r - x, 6) AS impact FROM i QUALIFY row_number() OVER (PARTITION BY year ORDER BY r - x DESC, security_id) = 1""")
def _removal(b):
    y = b("px_dense").groupBy(F.year("date").alias("year"), "security_id", "num").agg((F.min_by("close_adj", "date") * F.col("num")).alias("start_cap"), (F.max_by("close_adj", "date") * F.col("num")).alias("end_cap"))
    out = Q.removal_impact(y)
    return out.select("year", "security_id", *[R6(c).alias(c) for c in ("index_return", "return_without", "impact")])


_PANEL = DISCOUNT_SQL + ", pan AS (SELECT preferred_security_id AS entity, discount, discount_z, lead(discount, 5) OVER (PARTITION BY preferred_security_id ORDER BY date) - discount AS change FROM pd)"


def _panel(b):
    from pyspark.sql import Window

    from tessera.plans.identity import preferred_relations
    from tessera.plans.prices import preferred_discount

    d = preferred_discount(b("px").select("date", "security_id", F.col("close_adj").alias("close")), preferred_relations(b("names")))
    w = Window.partitionBy("preferred_security_id").orderBy("date")
    return d.select(F.col("preferred_security_id").alias("entity"), "discount", "discount_z", (F.lead("discount", 5).over(w) - F.col("discount")).alias("change"))


@query("pref_surge_table", "names", "px", sql=_PANEL + " SELECT CAST((discount_z >= -1.5)::INT + (discount_z >= 0)::INT + (discount_z >= 1.5)::INT AS INT) AS bucket, count(*) AS n, round(avg(change), 6) AS mean, round(avg(CASE WHEN change > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM pan WHERE discount_z IS NOT NULL AND change IS NOT NULL GROUP BY 1")
def _surge(b):
    return Q.surge_table(_panel(b), "discount_z", [-1.5, 0.0, 1.5], "change").select("bucket", "n", R6("mean").alias("mean"), R6("hit_rate").alias("hit_rate"))


@query("pref_decile_table", "names", "px", sql=_PANEL + ", v AS (SELECT * FROM pan WHERE discount IS NOT NULL AND change IS NOT NULL), e AS (SELECT quantile_cont(discount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM v) SELECT CAST(len(list_filter(q, lambda x: x < discount)) + 1 AS INT) AS decile, count(*) AS n, round(avg(change), 6) AS mean, round(min(discount), 6) AS low, round(max(discount), 6) AS high FROM v, e GROUP BY 1")
def _decile(b):
    return Q.decile_table(_panel(b), "discount", "change").select("decile", "n", *[R6(c).alias(c) for c in ("mean", "low", "high")])


@query("fe_ols_beta", "names", "px", sql=_PANEL + """, v AS (SELECT entity, change, discount FROM pan WHERE discount IS NOT NULL AND change IS NOT NULL), d AS (SELECT entity, change - avg(change) OVER w AS y, discount - avg(discount) OVER w AS x FROM v WINDOW w AS (PARTITION BY entity)),
  bt AS (SELECT sum(x * y) / sum(x * x) AS b, sum(x * x) AS sxx, count(*) AS n, count(DISTINCT entity) AS g FROM d), sc AS (SELECT entity, sum(x * (y - b * x)) AS s FROM d, bt GROUP BY entity)
  SELECT 'discount' AS term, round(any_value(b), 6) AS beta, round(sqrt(any_value(CASE WHEN g > 1 THEN CAST(g AS DOUBLE) / (g - 1) ELSE 1.0 END) * sum(s * s)) / any_value(sxx), 6) AS se FROM sc, bt""")
def _ols(b):
    return Q.fixed_effects_ols(_panel(b), "change", ["discount"], "entity").select("term", R6("beta").alias("beta"), R6("se").alias("se"))
