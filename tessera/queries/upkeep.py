"""Queries about keeping a lake up: incremental adjustment, kept actions, calendars, audits, grades."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import functions as F

from tessera.operators import calendar as C
from tessera.operators import quality as Q
from tessera.plans import fundamentals as FU
from tessera.plans import identity as I
from tessera.plans import prices as P
from tessera.queries import query
from tessera.queries.core import R6
from tessera.queries.medallion import _ACT
from tessera.sources.datasets import Lake

_MID = "1998-06-30"


@query("adjusted_prices_update", "capped", sql=_ACT + """, fac AS (SELECT c.*, coalesce((SELECT product(a.factor) FROM act a WHERE a.security_id = c.security_id AND a.effective_date > c.date), 1) AS factor FROM capped c),
  adj AS (SELECT *, close * factor AS ca FROM fac) SELECT date, security_id, round(ca, 6) AS close_adj, round(factor, 6) AS adjustment_factor, CASE WHEN volume > 0 AND lag(volume) OVER w > 0 THEN round(ca / lag(ca) OVER w - 1, 6) END AS return_1d FROM adj WINDOW w AS (PARTITION BY security_id ORDER BY date)""")
def _update(b):
    """A history stored half way, brought up to date, equals the full build."""
    c = b("capped")
    actions = P.share_jumps(c)
    middle = F.to_date(F.lit(_MID))
    old_actions = actions.where(F.col("effective_date") <= middle)
    stored = P.adjusted_prices(c.where(F.col("date") <= middle), old_actions)
    out = P.update_adjusted(stored, c, actions, old_actions)
    return out.select("date", "security_id", R6("close_adj").alias("close_adj"), R6("adjustment_factor").alias("adjustment_factor"), R6("return_1d").alias("return_1d"))


@query("corporate_actions_kept", "capped", sql=_ACT + """, own AS (SELECT *, CAST(substr(security_id, 2) AS BIGINT) % 3 = 0 AS m FROM act)
  SELECT effective_date, security_id, CASE WHEN m THEN 2.0 ELSE round(factor, 6) END AS factor, CASE WHEN m THEN 'manual' ELSE 'shares_jump' END AS source FROM own""")
def _kept(b):
    """Manual actions stay and win; a detected one that isn't found again goes."""
    found = P.share_jumps(b("capped")).select("effective_date", "security_id", R6("factor").alias("factor"), F.lit("shares_jump").alias("source"))
    manual = found.where(F.substring("security_id", 2, 20).cast("long") % 3 == 0).withColumn("factor", F.lit(2.0)).withColumn("source", F.lit("manual"))
    gone = found.withColumn("effective_date", F.date_add("effective_date", 1))
    return P.merge_actions(manual.unionByName(gone), found)


@query("calendar_neighbours", "axis", sql=""", d AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM axis) - 3, (SELECT max(date) FROM axis) + 3, INTERVAL 1 DAY)) AS DATE) AS date)
  SELECT d.date, EXISTS (SELECT 1 FROM axis a WHERE a.date = d.date) AS is_open, (SELECT max(a.date) FROM axis a WHERE a.date < d.date) AS previous, (SELECT min(a.date) FROM axis a WHERE a.date > d.date) AS next FROM d""")
def _neighbours(b):
    axis = b("axis")
    days = axis.agg(F.min("date").alias("a"), F.max("date").alias("z")).select(F.explode(F.sequence(F.date_sub("a", 3), F.date_add("z", 3))).alias("date"))
    return C.neighbours(days, axis).select("date", "is_open", "previous", "next")


_FLAG = """, j AS (SELECT x.date, x.security_id, x.return_1d, x.volume, u.is_halted FROM px_dense x JOIN universe u ON u.date = x.date AND u.security_id = x.security_id WHERE abs(x.return_1d) >= 0.05),
  f AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY date) >= 3 THEN 'clustered_date' WHEN coalesce(volume, 0) = 0 THEN 'zero_volume' WHEN is_halted THEN 'halted' ELSE 'large_return' END AS audit_flag FROM j)"""


def _flagged(b):
    audit = Q.jump_audit(b("px_dense"), 0.05).join(b("px_dense").select("date", "security_id", "volume"), ["date", "security_id"]).join(b("universe").select("date", "security_id", "is_halted"), ["date", "security_id"])
    return Q.flagged_jumps(audit, 3)


@query("price_jump_flags", "px_dense", "universe", sql=_FLAG + " SELECT date, security_id, audit_flag FROM f")
def _flags(b):
    return _flagged(b).select("date", "security_id", "audit_flag")


@query("price_jump_summary", "px_dense", "universe", sql=_FLAG + " SELECT security_id, count(*) AS event_count, min(date) AS first_event_date, max(date) AS last_event_date, round(max(abs(return_1d)), 6) AS max_abs_return, string_agg(DISTINCT audit_flag, '|' ORDER BY audit_flag) AS flags FROM f GROUP BY security_id")
def _flag_summary(b):
    return Q.jump_summary(_flagged(b)).withColumn("max_abs_return", R6("max_abs_return"))


@query("lake_scorecard", "px", "axis", "filings", sql=""", part AS (SELECT 'silver.prices' AS dataset, date, count(*) AS rows FROM px GROUP BY date UNION ALL SELECT 'silver.filings', rcept_dt, count(*) FROM filings GROUP BY rcept_dt),
  spec AS (SELECT * FROM (VALUES ('silver.prices', 2, FALSE), ('silver.filings', 10, FALSE), ('silver.nps_holdings', 130, TRUE), ('gold.universe_history', 2, FALSE)) v(dataset, limit_days, may)),
  k AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY date DESC) AS k FROM part QUALIFY k <= 21), g AS (SELECT dataset, max(date) AS last_date, max(rows) FILTER (k = 1) AS rows, list_sort(list(rows) FILTER (k > 1)) AS old FROM k GROUP BY dataset),
  h AS (SELECT spec.dataset, limit_days, may, last_date, (SELECT max(day_index) FROM axis) - a.day_index AS age_days, rows, old[len(old) // 2 + 1] AS typical_rows FROM spec LEFT JOIN g USING (dataset) LEFT JOIN axis a ON a.date = last_date)
  SELECT dataset, last_date, coalesce(age_days, -1) AS age_days, coalesce(rows, 0) AS rows, coalesce(typical_rows, 0) AS typical_rows, limit_days, CASE CASE WHEN last_date IS NULL THEN CASE WHEN may THEN 0 ELSE 2 END
    ELSE greatest(CASE WHEN age_days > 3 * limit_days THEN 2 WHEN age_days > limit_days THEN 1 ELSE 0 END, CASE WHEN rows < 0.1 * typical_rows THEN 2 WHEN rows < 0.5 * typical_rows THEN 1 ELSE 0 END) END WHEN 2 THEN 'F' WHEN 1 THEN 'C' ELSE 'A' END AS grade FROM h""")
def _lake(b):
    part = b("px").groupBy("date").agg(F.count("*").alias("rows")).select(F.lit("silver.prices").alias("dataset"), "date", "rows")
    part = part.unionByName(b("filings").groupBy(F.col("rcept_dt").alias("date")).agg(F.count("*").alias("rows")).withColumn("dataset", F.lit("silver.filings")))
    names = ("silver.prices", "silver.filings", "silver.nps_holdings", "gold.universe_history")
    out = Q.lake_scorecard(part, b("axis"), {n: Q.DATASET_LIMITS[n] for n in names}).fillna(-1, ["age_days"]).fillna(0, ["rows", "typical_rows"])
    return out.select("dataset", "last_date", "age_days", "rows", "typical_rows", "limit_days", "grade")


@query("accounts_by_name", "fin", sql="SELECT CASE account_id WHEN 'ifrs-full_Assets' THEN 'ifrs-full_Assets' WHEN 'ifrs-full_Liabilities' THEN 'ifrs-full_Liabilities' WHEN 'ifrs-full_Equity' THEN 'ifrs-full_Equity' ELSE '-custom' END AS account_id, count(*) AS n FROM (SELECT DISTINCT * FROM fin) GROUP BY 1")
def _named(b):
    said = {"ifrs-full_Assets": "자산 총계", "ifrs-full_Liabilities": "부채총계 (단위 : 원)", "ifrs-full_Equity": " 자본총계"}
    name = F.create_map(*[F.lit(x) for pair in said.items() for x in pair])[F.col("account_id")]
    raw = b("fin").select("*", F.coalesce(name, F.lit("기타")).alias("account_name")).withColumn("account_id", F.lit("-custom")).withColumn("corp_code", F.col("ticker"))
    return FU.financials_silver(raw).groupBy("account_id").agg(F.count("*").alias("n"))


@query("statement_requests", "filings", sql="SELECT stock_code AS corp_code, stock_code, bsns_year, report_code, min(rcept_dt) AS available_date FROM (SELECT *, CAST(regexp_extract(report_nm, '([0-9]{4})[.]', 1) AS INT) AS bsns_year, CASE WHEN report_nm LIKE '%사업보고서%' THEN '11011' WHEN report_nm LIKE '%분기보고서%' THEN '11013' END AS report_code FROM filings) WHERE report_code IS NOT NULL AND rcept_dt BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY ALL")
def _requests(b):
    title = F.col("report_nm")
    code = F.when(title.contains("사업보고서"), "11011").when(title.contains("분기보고서"), "11013")
    report = F.when(code.isNotNull(), F.struct(F.regexp_extract(title, r"([0-9]{4})[.]", 1).cast("int").alias("bsns_year"), code.alias("report_code")))
    return FU.statement_requests(b("filings").withColumn("corp_code", F.col("stock_code")), report, ("11011", "11013"), "1996-01-01", "1998-12-31")


@query("preferred_by_name", "names", sql=", s AS (SELECT security_id, ticker, name, CASE WHEN name NOT LIKE '%우' THEN ticker END AS corp_code, CASE WHEN name LIKE '%우' THEN 'preferred' ELSE 'common' END AS share_class FROM names), j AS (SELECT c.corp_code, p.security_id, p.ticker, count(*) OVER (PARTITION BY c.corp_code) AS n FROM s c JOIN s p ON p.share_class = 'preferred' AND p.corp_code IS NULL AND starts_with(p.name, c.name) WHERE c.share_class = 'common' AND c.corp_code IS NOT NULL) SELECT corp_code, security_id, ticker FROM j WHERE n = 1")
def _by_name(b):
    n = b("names")
    preferred = F.col("name").endswith("우")
    return I.preferred_by_name(n.select("security_id", "ticker", "name", F.when(~preferred, F.col("ticker")).alias("corp_code"), F.when(preferred, "preferred").otherwise("common").alias("share_class")))


def _lake_root(spark) -> str:
    """A folder of its own under the shared one (a local one on a local master without it); it goes when the driver's Python ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or ("/tmp/checkpoints/tessera" if spark.sparkContext.master.startswith("local") else None)
    if shared is None:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = f"{shared.rstrip('/')}/lake-{uuid.uuid4().hex[:12]}"

    def drop() -> None:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended
            pass

    atexit.register(drop)
    return root


_ROUND = "CAST(sum(CAST(floor(amount * 100 + 0.5) AS BIGINT)) AS BIGINT) AS cents"


@query("sink_partitions", "fin", sql=f"SELECT fiscal_year, account_id, count(*) AS n, {_ROUND} FROM fin WHERE fiscal_year > 1993 OR is_consolidated GROUP BY 1, 2")
def _partitions_written(b):
    """Written by year; years written again are replaced, the others stay."""
    lake = Lake(b.spark, _lake_root(b.spark))
    fin = b("fin")
    lake.write(fin.where("is_consolidated"), "silver.financials", "fiscal_year")
    lake.write(fin.where("fiscal_year > 1993"), "silver.financials", "fiscal_year")
    back = lake.read("silver.financials")
    return back.groupBy(F.year("fiscal_period_end").alias("fiscal_year"), "account_id").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("amount") * 100 + 0.5).cast("long")).alias("cents"))


@query("sink_merge", "divs", sql="SELECT security_id, fiscal_year, max(available_date) AS available_date, CAST(max(CASE WHEN m THEN 2 ELSE 1 END) AS INT) AS version FROM (SELECT *, max(o_orderkey % 2) OVER (PARTITION BY security_id, fiscal_year) = 1 AS m, max(CASE WHEN o_orderkey % 2 = 1 THEN available_date END) OVER (PARTITION BY security_id, fiscal_year) AS nd FROM divs) WHERE NOT m OR (o_orderkey % 2 = 1 AND available_date = nd) GROUP BY 1, 2")
def _merged(b):
    """Stored rows and newer ones, one per security and year: the newer where there is one."""
    lake = Lake(b.spark, _lake_root(b.spark))
    d = b("divs").select("security_id", "fiscal_year", "available_date", "o_orderkey")
    newest = lambda df: df.groupBy("security_id", "fiscal_year").agg(F.max("available_date").alias("available_date"))
    lake.write(newest(d).withColumn("version", F.lit(1)), "silver.dividends", "fiscal_year")
    lake.merge(newest(d.where("o_orderkey % 2 = 1")).withColumn("version", F.lit(2)), "silver.dividends", ["security_id", "fiscal_year"], "fiscal_year", ["available_date"])
    return lake.read("silver.dividends").select("security_id", F.col("fiscal_year").cast("int").alias("fiscal_year"), "available_date", "version")
