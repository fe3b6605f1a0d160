"""Bridge views: equity-shaped tables derived from the star-schema test tables by one SQL text that Spark and DuckDB both run.

Prices are quotients of whole numbers, so both engines hold the same doubles. BRIDGE has, by name, the SQL and the names it
rests on; `ctes` gives the WITH list of a set of names in order.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.backtest import Quotes

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

_TITLES = "CASE CAST(o_orderkey % 12 AS INT) WHEN 0 THEN '주요사항보고서(자기주식 취득 결정)' WHEN 1 THEN '주요사항보고서(유상증자결정)' WHEN 2 THEN '현금ㆍ현물배당 결정' WHEN 3 THEN '자기주식처분 결정' WHEN 4 THEN '사업보고서 (2023.12)' WHEN 5 THEN '최대주주변경' WHEN 6 THEN '단일판매ㆍ공급계약체결' WHEN 7 THEN CASE WHEN o_orderkey % 24 = 19 THEN '액면분할결정' ELSE '주식분할 결정' END WHEN 8 THEN '회사합병 결정' WHEN 9 THEN '횡령ㆍ배임혐의발생' WHEN 10 THEN '전환사채권발행결정' ELSE '분기보고서 (2023.03)' END"

BRIDGE: dict[str, tuple[tuple[str, ...], str]] = {
    "nsupp": ((), "SELECT CAST(max(s_suppkey) AS BIGINT) AS n FROM supplier"),
    "px": ((), """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS BIGINT) AS num, 'S' || lpad(CAST(l_suppkey AS STRING), 6, '0') AS security_id,
  lpad(CAST(l_suppkey AS STRING), 6, '0') AS ticker,
  CAST((100 * count(*) + sum(CAST(floor(l_discount * 100 + 0.5) AS BIGINT))) * (100 * count(*) + sum(CAST(floor(l_tax * 100 + 0.5) AS BIGINT))) AS DOUBLE) / CAST(100 * count(*) * count(*) AS DOUBLE) AS close_adj,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume, CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100 AS trading_value
  FROM lineitem GROUP BY l_shipdate, l_suppkey"""),
    "axis": (("px",), "SELECT date, CAST(row_number() OVER (ORDER BY date) AS BIGINT) AS day_index FROM (SELECT DISTINCT date FROM px) d"),
    "grid": (("px", "axis"), """SELECT a.date, a.day_index, s.num, s.security_id, s.ticker, p.close_adj AS traded, coalesce(p.volume, 0) AS volume,
  count(p.close_adj) OVER (PARTITION BY s.security_id ORDER BY a.date) AS run
  FROM axis a CROSS JOIN (SELECT DISTINCT num, security_id, ticker FROM px) s LEFT JOIN px p ON p.date = a.date AND p.security_id = s.security_id"""),
    "filled": (("grid",), "SELECT date, day_index, num, security_id, ticker, volume, max(traded) OVER (PARTITION BY security_id, run) AS close_adj FROM grid WHERE run > 0"),
    "px_dense": (("filled",), """SELECT date, day_index, num, security_id, ticker, volume, close_adj, close_adj / lag(close_adj) OVER (PARTITION BY security_id ORDER BY date) - 1 AS return_1d,
  CAST(1000000 * (1 + (year(date) + num) % 2) AS BIGINT) AS listed_shares, floor(close_adj * 1000000 + 0.5) * 1.0E0 AS market_cap FROM filled"""),
    "universe": (("filled",), """SELECT date, security_id, ticker, CASE WHEN num % 2 = 0 THEN 'KOSPI' ELSE 'KOSDAQ' END AS market, NOT (num % 13 = 0 AND date > DATE '2000-06-30') AS is_active,
  CASE WHEN num % 10 = 5 THEN 'preferred' ELSE 'common' END AS share_class, CASE WHEN num % 19 = 0 THEN 'reit' ELSE 'equity' END AS security_type,
  num % 17 = 0 AS is_spac_pre, (num + day_index) % 97 = 0 AS is_halted FROM filled"""),
    "month_axis": (("axis",), "SELECT max(date) AS date FROM axis GROUP BY year(date), month(date)"),
    "fin": (("nsupp",), """SELECT 'S' || lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS security_id, lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS ticker,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN CASE WHEN o_orderkey % 7 = 0 THEN 'ifrs-full_ProfitLossBeforeTax' ELSE 'ifrs-full_ProfitLoss' END WHEN '2' THEN CASE WHEN o_orderkey % 7 = 0 THEN 'dart_AcquisitionOfTreasuryShares' ELSE 'ifrs-full_Assets' END
  WHEN '3' THEN CASE WHEN o_orderkey % 7 = 0 THEN 'ifrs-full_EquityAndLiabilities' ELSE 'ifrs-full_Equity' END WHEN '4' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'dart_OperatingIncomeLoss' ELSE 'ifrs-full_Revenue' END
  ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'ifrs-full_DividendsPaid' ELSE 'ifrs-full_Liabilities' END END AS account_id,
  CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL '3' MONTH - INTERVAL '1' DAY AS DATE) AS fiscal_period_end, CAST(year(o_orderdate) AS INT) AS fiscal_year,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL '45' DAY AS DATE) AS available_date, CASE WHEN month(o_orderdate) > 9 THEN '11011' ELSE '11014' END AS report_type,
  o_orderstatus = 'F' AS is_consolidated, o_totalprice AS amount, lpad(CAST(o_orderkey AS STRING), 14, '0') AS rcept_no FROM orders CROSS JOIN nsupp"""),
    "filings": (("nsupp",), f"""SELECT lpad(CAST(o_orderkey AS STRING), 14, '0') AS rcept_no, CAST(o_orderdate AS DATE) AS rcept_dt, CAST(CAST(o_orderdate AS DATE) + INTERVAL '1' DAY AS DATE) AS available_date,
  'S' || lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS security_id, lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS stock_code,
  CASE o_orderkey % 7 WHEN 0 THEN '[기재정정]' WHEN 1 THEN '[첨부추가] [기재정정]' WHEN 2 THEN ' [첨부추가]' ELSE '' END || {_TITLES} AS report_nm, o_orderkey % 11 = 0 AS is_correction FROM orders CROSS JOIN nsupp"""),
    "divs": (("nsupp",), """SELECT 'S' || lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS security_id, lpad(CAST(o_custkey % n + 1 AS STRING), 6, '0') AS ticker, CAST(year(o_orderdate) - 1 AS INT) AS fiscal_year,
  CAST(date_trunc('year', CAST(o_orderdate AS DATE)) - INTERVAL '1' DAY AS DATE) AS fiscal_period_end, CAST(o_orderdate AS DATE) AS available_date, floor(o_totalprice / 1000) * 1.0E0 AS cash_dividend_per_share,
  CAST(o_orderkey % 50 AS DOUBLE) / 10 AS cash_dividend_yield_pct, '11011' AS report_type, o_orderkey FROM orders CROSS JOIN nsupp WHERE o_orderkey % 5 = 0"""),
    "nps": (("axis",), """SELECT q.date, 'S' || lpad(CAST(s.s_suppkey AS STRING), 6, '0') AS security_id, lpad(CAST(s.s_suppkey AS STRING), 6, '0') AS stock_code, CAST((s.s_suppkey * 7 + q.k * 13) % 1000 AS DOUBLE) / 100 AS ownership_pct,
  CAST((s.s_suppkey * 31 + q.k * 17) % 977 AS DOUBLE) AS market_value
  FROM (SELECT date, row_number() OVER (ORDER BY date) AS k FROM (SELECT min(date) AS date FROM axis GROUP BY year(date), quarter(date)) m) q CROSS JOIN supplier s WHERE (s.s_suppkey + q.k) % 3 <> 0"""),
    "raw_prices": (("px",), """SELECT date, ticker, security_id, num, source, close, volume FROM (
  SELECT date, ticker, security_id, num, 'krx' AS source, close_adj AS close, volume FROM px WHERE num % 3 <> 0
  UNION ALL SELECT date, ticker, security_id, num, 'naver' AS source, close_adj * 1.5 AS close, volume FROM px WHERE num % 2 = 0
  UNION ALL SELECT date, ticker, security_id, num, 'naver' AS source, close_adj * 0.25 AS close, volume + 1 AS volume FROM px WHERE num % 2 = 0 AND volume % 3 = 0
  UNION ALL SELECT date, ticker, security_id, num, 'pre2010' AS source, close_adj + 1 AS close, volume FROM px) u"""),
    "names": (("px",), """SELECT DISTINCT security_id, ticker, CASE WHEN num % 10 = 5 THEN 'Corp' || CAST(num - 5 AS STRING) || '우' WHEN num % 10 = 7 THEN 'Other ' || CAST(num AS STRING) WHEN num % 19 = 0 THEN 'Land' || CAST(num AS STRING) || ' 리츠'
  WHEN num % 17 = 0 THEN 'Alpha' || CAST(num AS STRING) || '호스팩' WHEN num % 23 = 0 THEN 'KBSTAR ' || CAST(num AS STRING) WHEN num % 29 = 0 THEN 'TRUE ' || CAST(num AS STRING) || ' ETN' WHEN num % 31 = 0 THEN 'TIGERAIR ' || CAST(num AS STRING) ELSE 'Corp' || CAST(num AS STRING) END AS name FROM px"""),
    "capped": (("px",), """SELECT date, security_id, ticker, num, CAST(1000000 * (1 + (year(date) + num) % 2) AS BIGINT) AS listed_shares, close_adj / CAST(1 + (year(date) + num) % 2 AS DOUBLE) AS close, volume,
  CAST(NULL AS DOUBLE) AS market_cap, 'raw' AS price_basis, 'krx' AS price_source FROM px"""),
    "macro": (("axis",), "SELECT 'CPI' AS series_id, date, 100 + CAST(day_index % 37 AS DOUBLE) / 4 + CAST(day_index AS DOUBLE) / 50 AS value, day_index FROM (SELECT min(date) AS d0, year(date) AS y, month(date) AS m, min(day_index) AS day_index, CAST(date_trunc('month', min(date)) AS DATE) AS date FROM axis GROUP BY year(date), month(date)) x"),
}


def ctes(*names: str) -> str:
    """'WITH a AS (...), b AS (...)' for the names and all that they rest on."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in BRIDGE[name][0]:
                add(other)
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({BRIDGE[n][1]})" for n in order)


def _axis(b: "Bridge") -> DataFrame:
    """The days of px are those of its lines; no prices are needed for them."""
    days = b.table("lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    return days.withColumn("day_index", F.row_number().over(Window.orderBy("date")).cast("long"))


def dealt_prices(b: "Bridge") -> DataFrame:
    """The rows of px with a price (without trading_value), dealt by security in one shuffle that the windows on securities use too."""
    lines = b.table("lineitem").select("l_shipdate", F.expr("CAST(l_suppkey AS BIGINT)").alias("num"), *[F.expr(f"CAST(floor({c} * 100 + 0.5) AS BIGINT)").alias(c) for c in ("l_discount", "l_tax")], F.expr("CAST(l_quantity AS BIGINT)").alias("l_quantity"))
    lines = lines.withColumn("security_id", F.expr("'S' || lpad(CAST(num AS STRING), 6, '0')")).where("num IS NOT NULL AND security_id IS NOT NULL AND CAST(l_shipdate AS DATE) IS NOT NULL").repartition("security_id")
    close = "CAST((100 * count(*) + sum(l_discount)) * (100 * count(*) + sum(l_tax)) AS DOUBLE) / CAST(100 * count(*) * count(*) AS DOUBLE)"
    px = lines.groupBy("security_id", "num", "l_shipdate").agg(F.expr(close).alias("close_adj"), F.sum("l_quantity").alias("volume"))
    return px.select(F.col("l_shipdate").cast("date").alias("date"), "num", "security_id", F.expr("lpad(CAST(num AS STRING), 6, '0')").alias("ticker"), "close_adj", "volume")


def quotes(b: "Bridge") -> Quotes:
    """The returns of px_dense as Quotes: nothing is spread over the days between prices."""
    px = dealt_prices(b).where("close_adj IS NOT NULL")
    last = F.lag("close_adj").over(Window.partitionBy("security_id").orderBy("date"))
    returns = px.select("date", "security_id", (F.col("close_adj") / last - 1).alias("return_1d")).where("return_1d IS NOT NULL")
    return Quotes(returns, px.groupBy("security_id").agg(F.min("date").alias("since")))


def filled_on(b: "Bridge", days: DataFrame | None = None) -> DataFrame:
    """The rows of `filled`, all or those of some days (day_index). Each price is spread from its day to the day before the security's
    next one, over the days asked for alone, so no grid of days and securities is made or shuffled."""
    axis = b("axis")
    order = Window.partitionBy("security_id").orderBy("day_index")
    end = axis.agg((F.max("day_index") + 1).alias("end"))
    traded = dealt_prices(b).join(F.broadcast(axis), "date").crossJoin(F.broadcast(end))
    close = F.last("close_adj", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = traded.select("day_index", "num", "security_id", "ticker", "volume", close.alias("close_adj"), (F.coalesce(F.lead("day_index").over(order), "end") - 1).alias("last"))
    spans = spans.where("close_adj IS NOT NULL").withColumnRenamed("day_index", "first")
    if days is None:
        each = spans.withColumn("day_index", F.explode(F.sequence("first", "last")))
    else:
        # days asked for that are in the calendar have numbers; the calendar tells how many of them lie before and up to each of its days
        asked = axis.select("day_index").join(F.broadcast(days.select("day_index").distinct()), "day_index", "left_semi").withColumn("n", F.row_number().over(Window.orderBy("day_index")))
        upto = F.count("n").over(Window.orderBy("day_index").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
        counts = axis.select("day_index").join(F.broadcast(asked), "day_index", "left").select("day_index", "n", upto.alias("upto"))
        before = counts.select(F.col("day_index").alias("first"), (F.col("upto") - F.col("n").isNotNull().cast("int")).alias("lo"))
        spans = spans.join(F.broadcast(before), "first").join(F.broadcast(counts.select(F.col("day_index").alias("last"), F.col("upto").alias("hi"))), "last")
        each = spans.where("hi > lo").withColumn("n", F.explode(F.sequence(F.col("lo") + 1, F.col("hi")))).join(F.broadcast(asked), "n")
    volume = F.when(F.col("day_index") == F.col("first"), F.coalesce("volume", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("volume")
    return each.join(F.broadcast(axis), "day_index").select("date", "day_index", "num", "security_id", "ticker", volume, "close_adj")


def universe_on(b: "Bridge", days: DataFrame) -> DataFrame:
    """The rows of `universe`, which goes row by row, on some days (day_index)."""
    filled_on(b, days).createOrReplaceTempView("filled")
    out = b.spark.sql(BRIDGE["universe"][1])
    b("filled").createOrReplaceTempView("filled")
    return out


#: Names that Spark makes by a plan of its own, with the rows of their SQL; whatever rests on them reads these.
PLANS = {"axis": _axis, "filled": filled_on}


class Bridge:
    """The views as DataFrames over one directory of tables."""

    _kept: list[DataFrame] = []

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        for name in BASE:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
        self._made: dict[str, DataFrame] = {}
        self._mine: list[DataFrame] = []

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def keep(self, df: DataFrame) -> DataFrame:
        """Stores a table that this query reads several times. Tables kept for earlier queries are let go; a result that still reads one computes it anew."""
        if not self._mine:
            for old in Bridge._kept:
                old.unpersist()
            self._mine = Bridge._kept = []
        self._mine.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in PLANS:
                self._made[name] = PLANS[name](self)
            else:
                # a view at a time: the optimizer can fail when it puts a held table in place of a WITH name read several times
                for other in BRIDGE[name][0]:
                    self(other).createOrReplaceTempView(other)
                self._made[name] = self.spark.sql(BRIDGE[name][1])
        return self._made[name]
