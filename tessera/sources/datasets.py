"""The datasets by name: layer, folder, partition columns and declared schema; reading, writing, catalog views.

A dataset without files reads as an empty table of its declared schema, so every view exists from the start. Files may hold more
columns than declared; schemas of files are merged by name.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Declared columns of the datasets.
_META = "_ingested_at timestamp, _source string, _source_request_hash string"
_FLAGS = "is_halted boolean, is_designated boolean, is_liquidation_window boolean"
_PRICE_RAW = f"date date, ticker string, isin string, name string, market string, open double, high double, low double, close double, volume long, trading_value long, market_cap long, listed_shares long, {_META}"
_PRICE_SILVER = f"date date, security_id string, listing_id string, ticker string, name string, market string, open double, high double, low double, close double, volume long, trading_value long, market_cap long, listed_shares long, price_source string, price_basis string, {_FLAGS}"
_PRICE_GOLD = f"date date, security_id string, listing_id string, open_adj double, high_adj double, low_adj double, close_adj double, return_1d double, volume long, trading_value long, market_cap long, listed_shares long, {_FLAGS}"
_FILINGS_RAW = f"rcept_dt date, corp_code string, corp_name string, stock_code string, rcept_no string, report_nm string, rm string, {_META}"
_FILINGS = "rcept_no string, rcept_dt date, available_date date, corp_code string, corp_name string, stock_code string, security_id string, report_nm string, is_correction boolean"
_EVENTS = "event_date date, available_date date, security_id string, ticker string, event_type string, expected_sign int, rcept_no string, report_nm string, is_correction boolean"
_FINANCIALS = "security_id string, corp_code string, fiscal_period_end date, event_date date, rcept_dt date, available_date date, report_type string, account_id string, account_name string, amount double, is_consolidated boolean, accounting_basis string, is_backfilled boolean"
_COMPANY = f"snapshot_dt date, corp_code string, corp_name string, stock_code string, modify_date string, {_META}"
_SUMMARY = f"snapshot_dt date, ticker string, name string, market string, close long, change_abs long, change_rate_pct double, par_value long, market_cap long, listed_shares long, foreign_ownership_pct double, volume long, per double, roe double, {_META}"
_HOLDING_TAIL = "source string, source_date date, source_market_value double, source_weight_pct double, shares_source string, price_date date, is_exact_price boolean"
_HOLDINGS_RAW = f"date date, stock_code string, stock_name string, shares long, ownership_pct double, price double, market_value double, change_pct double, rank long, {_HOLDING_TAIL}, {_META}"
_HOLDINGS = f"date date, security_id string, listing_id string, stock_code string, stock_name string, shares long, ownership_pct double, price double, market_value double, change_pct double, source_rank long, {_HOLDING_TAIL}"
_HOLDINGS_DELTA = "security_id string, ticker string, snapshot_date date, prev_snapshot_date date, available_date date, holding_ratio double, prev_holding_ratio double, delta_ratio double, entered boolean, exited boolean"
_HOLDINGS_UNIVERSE = "date date, as_of date, rank long, security_id string, listing_id string, stock_code string, stock_name string, shares long, ownership_pct double, price double, market_value double, change_pct double, source string, source_date date"
_MARCAP_RAW = "Date date, Rank long, Code string, Name string, Open long, High long, Low long, Close long, Volume long, Amount long, Changes long, ChangeCode string, ChagesRatio double, Marcap long, Stocks long, MarketId string, Market string, Dept string"
_CAPS = "date date, security_id string, listing_id string, ticker string, name string, market string, rank long, close double, trading_value long, volume long, market_cap long, listed_shares long, market_cap_source string, is_estimated boolean"
_MASTER = "issuer_id string, security_id string, listing_id string, corp_code string, isin string, ticker string, name string, market string, share_class string, security_type string, listed_date date, delisted_date date, delisting_reason string"
_UNIVERSE = f"date date, security_id string, listing_id string, market string, is_active boolean, share_class string, security_type string, is_spac_pre boolean, {_FLAGS}"
_ACTIONS = "effective_date date, security_id string, action_type string, adjustment_factor double, source_rcept_no string, source string, confidence string"
_DIVIDENDS = "fiscal_year int, fiscal_period_end date, rcept_dt date, available_date date, corp_code string, corp_name string, security_id string, ticker string, share_class string, stock_kind string, cash_dividend_per_share double, stock_dividend_per_share double, cash_dividend_yield_pct double, currency string, source_rcept_no string, report_type string, source string, is_estimated boolean"
_SHARES = "fiscal_year int, fiscal_period_end date, rcept_dt date, available_date date, corp_code string, corp_name string, share_class string, stock_kind string, authorized_shares double, cumulative_issued_shares double, cumulative_decreased_shares double, capital_reduction_shares double, profit_retirement_shares double, redemption_shares double, other_decrease_shares double, issued_shares double, treasury_shares double, outstanding_shares double, source_rcept_no string, report_type string, source string, is_estimated boolean"
_RELATIONS = "common_security_id string, preferred_security_id string, common_ticker string, preferred_ticker string, preferred_name string, relation_type string, confidence string, first_seen_date date, last_seen_date date"
_DISCOUNT = "date date, common_security_id string, preferred_security_id string, preferred_ticker string, common_close double, preferred_close double, discount double, discount_mean_252 double, discount_std_252 double, discount_z double, confidence string"
_REVIEW = "ticker string, gap_start date, gap_end date, name_before string, name_after string, name_changed boolean"
_SERIES = "date date, country string, series_id string, name string, frequency string"
_CPI = f"{_SERIES}, value double, index_base string, yoy_pct double, mom_pct double, source string, updated_at timestamp"
_RATES = f"{_SERIES}, tenor string, value double, unit string, source string, updated_at timestamp"
_INDICES = f"{_SERIES}, category string, value double, currency string, return_1d double, return_1m double, source string, updated_at timestamp"
_COMMODITIES = "date date, series_id string, name string, commodity string, value double, unit string, currency string, source string, updated_at timestamp"
_FX = "date date, series_id string, base_currency string, quote_currency string, value double, source string, updated_at timestamp"
_INDICATORS = "date date, country string, series_id string, name string, category string, frequency string, value double, unit string, source string, updated_at timestamp"


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    folder: str
    ddl: str
    partitions: tuple[str, ...] = ()

    @property
    def layer(self) -> str:
        return self.name.partition(".")[0]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _specs(*rows: tuple[str, str, str, str]) -> dict[str, DatasetSpec]:
    return {name: DatasetSpec(name, folder, ddl, tuple(filter(None, parts.split(",")))) for name, folder, ddl, parts in rows}


REGISTRY = _specs(
    ("bronze.krx_daily_raw", "bronze/krx_daily", _PRICE_RAW, "dt"),
    ("bronze.kis_daily_raw", "bronze/kis_daily", _PRICE_RAW, "dt"),
    ("bronze.naver_daily_raw", "bronze/naver_daily", _PRICE_RAW, "request_dt,chunk"),
    ("bronze.naver_summary_raw", "bronze/naver_summary", _SUMMARY, "dt"),
    ("bronze.nps_holdings_raw", "bronze/nps_holdings", _HOLDINGS_RAW, "dt"),
    ("bronze.marcap_raw", "bronze/marcap", _MARCAP_RAW, "year"),
    ("bronze.dart_filings_raw", "bronze/dart_filings", _FILINGS_RAW, "dt"),
    ("bronze.dart_financials_raw", "bronze/dart_financials", _FINANCIALS, "rcept_dt"),
    ("bronze.dart_company_raw", "bronze/dart_company", _COMPANY, "snapshot_dt"),
    ("bronze.pre2010_raw", "bronze/pre2010", _PRICE_RAW, "source,dt"),
    ("silver.prices", "silver/prices", _PRICE_SILVER, "dt"),
    ("silver.market_caps", "silver/market_caps", _CAPS, "dt"),
    ("silver.financials", "silver/financials", _FINANCIALS, "fiscal_year"),
    ("silver.filings", "silver/filings", _FILINGS, "dt"),
    ("silver.corporate_actions", "silver/corporate_actions", _ACTIONS, "dt"),
    ("silver.dividends", "silver/dividends", _DIVIDENDS, "fiscal_year"),
    ("silver.share_counts", "silver/share_counts", _SHARES, "fiscal_year"),
    ("silver.nps_holdings", "silver/nps_holdings", _HOLDINGS, "dt"),
    ("silver.security_identity", "silver/security_identity", _MASTER, ""),
    ("silver.security_relations", "silver/security_relations", _RELATIONS, ""),
    ("gold.daily_prices_adj", "gold/daily_prices_adj", _PRICE_GOLD, "dt"),
    ("gold.daily_market_caps", "gold/daily_market_caps", _CAPS, "dt"),
    ("gold.fundamentals_pit", "gold/fundamentals_pit", f"as_of_date date, {_FINANCIALS}", "dt"),
    ("gold.filing_events", "gold/filing_events", _EVENTS, "dt"),
    ("gold.universe_history", "gold/universe_history", _UNIVERSE, "dt"),
    ("gold.nps_universe", "gold/nps_universe", _HOLDINGS_UNIVERSE, "dt"),
    ("gold.nps_holdings_delta", "gold/nps_holdings_delta", _HOLDINGS_DELTA, "dt"),
    ("gold.preferred_discount", "gold/preferred_discount", _DISCOUNT, "dt"),
    ("gold.security_master", "gold/security_master", _MASTER, ""),
    ("gold.identity_review", "gold/identity_review", _REVIEW, ""),
    ("macro.cpi", "macro/cpi", _CPI, ""),
    ("macro.rates", "macro/rates", _RATES, ""),
    ("macro.indices", "macro/indices", _INDICES, ""),
    ("macro.commodities", "macro/commodities", _COMMODITIES, ""),
    ("macro.fx", "macro/fx", _FX, ""),
    ("macro.economic_indicators", "macro/economic_indicators", _INDICATORS, ""),
)


class Lake:
    """Datasets under one root, which may be any folder that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{REGISTRY[name].folder}"

    def _files(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(target)) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(target))

    def read(self, name: str) -> DataFrame:
        """Declared columns come first, then what files have besides; missing ones are NULL."""
        spec = REGISTRY[name]
        empty = self.spark.createDataFrame([], spec.schema)
        if not self._files(self.path(name)):
            return empty
        found = self.spark.read.option("mergeSchema", "true").option("basePath", self.path(name)).parquet(self.path(name))
        have = {f.name: f.dataType.simpleString() for f in found.schema.fields}
        declared = [(F.col(f.name) if have[f.name] == f.dataType.simpleString() else F.col(f.name).try_cast(f.dataType)).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
        rest = [F.col(c) for c in found.columns if c not in spec.schema.names and c not in spec.partitions]
        return found.select(*declared, *rest)

    def read_dates(self, name: str, dates: list[str], column: str = "dt") -> DataFrame:
        """Rows of some partition dates; only their folders are read."""
        if not self._files(self.path(name)):
            return self.spark.createDataFrame([], REGISTRY[name].schema)
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(name)).where(F.col(column).cast("string").isin(dates))

    def partition_dates(self, name: str) -> list[str]:
        """Values of the first partition column, from folder names alone."""
        spec = REGISTRY[name]
        if not spec.partitions or not self._files(self.path(name)):
            return []
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = (s.getPath().getName() for s in fs.listStatus(target))
        return sorted(n.partition("=")[2] for n in names if n.startswith(f"{spec.partitions[0]}="))

    def write(self, df: DataFrame, name: str, by: str | None = None, mode: str = "overwrite", request: dict | None = None, source: str | None = None) -> None:
        """Writes a dataset. Partitioned ones replace only the partitions they touch; by names the date that becomes `dt`.

        mode `fail` is append-only: it raises where a partition (or the table) is there already. Rows without partition value go.
        """
        spec = REGISTRY[name]
        if request is not None or source is not None:
            df = df.withColumn("_ingested_at", F.current_timestamp()).withColumn("_source", F.lit(source)).withColumn("_source_request_hash", F.lit(request_hash(request or {})))
        if not spec.partitions:
            df.coalesce(1).write.mode("errorifexists" if mode == "fail" else "overwrite").parquet(self.path(name))
            return
        keys = list(spec.partitions)
        if by and by != keys[0]:
            df = df.withColumn(keys[0], F.col(by))
        df = df.where(F.col(keys[0]).isNotNull())
        if mode == "fail":
            held = set(self.partition_dates(name))
            new = {str(r[0]) for r in df.select(keys[0]).distinct().collect()}  # partition values of one write
            if held & new:
                raise FileExistsError(f"{name} has {sorted(held & new)[:3]}")
        # one file per partition value and task: rows of a value meet in one task only if they fit, else adaptive execution splits them
        df.hint("rebalance", *keys).write.mode("append" if mode == "fail" else "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(self.path(name))

    def merge(self, new: DataFrame, name: str, keys: list[str], by: str, order: list[str] | None = None) -> None:
        """Rows of both, the new one per key, in the touched partitions only."""
        spec = REGISTRY[name]
        part = spec.partitions[0]
        fresh = new.withColumn(part, F.col(by).cast("string")).withColumn("_new", F.lit(1))
        days = [r[0] for r in fresh.select(part).distinct().collect()]  # partition values of one write
        if self._files(self.path(name)):
            old = self.spark.read.option("mergeSchema", "true").parquet(self.path(name)).withColumn(part, F.col(part).cast("string")).where(F.col(part).isin(days)).withColumn("_new", F.lit(0))
            fresh = fresh.unionByName(old, allowMissingColumns=True)
        ranks = [F.col("_new").desc(), *[F.col(c).desc_nulls_last() for c in (order or [c for c in new.columns if c not in keys])]]
        out = fresh.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranks))).where("_r = 1").drop("_r", "_new")
        staged = f"{self.path(name)}__staged"
        out.write.mode("overwrite").parquet(staged)  # what is read can't be overwritten in place
        self.spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(self.path(name))
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def register(self) -> DataFrame:
        """A temporary view layer_name for each dataset and for the analytics joins; gives the table of datasets."""
        for name in REGISTRY:
            self.read(name).createOrReplaceTempView(name.replace(".", "_"))
        master = "gold_security_master"
        join = f"LEFT JOIN (SELECT security_id AS _s, ticker AS _t, name, market AS _m, share_class, security_type FROM {master}) m ON m._s = p.security_id"
        views = {
            "analytics_securities": f"SELECT * FROM {master}",
            "analytics_daily_prices": f"SELECT p.*, m._t AS ticker, m.name, m._m AS market, m.share_class, m.security_type FROM gold_daily_prices_adj p {join}",
            "analytics_daily_market_caps": "SELECT * FROM gold_daily_market_caps",
            "analytics_universe": f"SELECT p.*, m._t AS ticker, m.name FROM gold_universe_history p {join}",
            "analytics_nps_universe": "SELECT * FROM gold_nps_universe",
        }
        for name, sql in views.items():
            self.spark.sql(sql).createOrReplaceTempView(name)
        return self.spark.createDataFrame([(s.name, s.layer, s.folder, ",".join(s.partitions), self._files(self.path(s.name))) for s in REGISTRY.values()], "name string, layer string, folder string, partitions string, has_files boolean")


def request_hash(parameters: dict) -> str:
    """sha256 of the parameters as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()
