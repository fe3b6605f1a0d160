"""The builders in their order: bronze to silver to gold over a Lake. Each step is a function of DataFrames; Spark spills where
memory is short, so nothing is chunked by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans import filings as FI
from tessera.plans import fundamentals as FU
from tessera.plans import holdings as H
from tessera.plans import identity as I
from tessera.plans import prices as P
from tessera.sources.datasets import REGISTRY, Lake

SOURCES = {"krx": "bronze.krx_daily_raw", "kis": "bronze.kis_daily_raw", "naver": "bronze.naver_daily_raw", "pre2010": "bronze.pre2010_raw"}


def _shape(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a dataset."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in REGISTRY[name].schema.fields])


def _put(lake: Lake, df: DataFrame, name: str, by: str | None = None) -> None:
    lake.write(_shape(df, name), name, by)


def build_market_caps(lake: Lake) -> None:
    raw = lake.read("bronze.marcap_raw")
    df = raw.select(F.col("Date").alias("date"), F.col("Code").alias("ticker"), F.col("Name").alias("name"), F.col("Market").alias("market"), F.col("Rank").alias("rank"), F.col("Close").cast("double").alias("close"), F.col("Amount").alias("trading_value"), F.col("Volume").alias("volume"), F.col("Marcap").alias("market_cap"), F.col("Stocks").alias("listed_shares"))
    df = df.where("date IS NOT NULL AND ticker IS NOT NULL").withColumns({"security_id": F.concat(F.lit("S"), "ticker"), "listing_id": F.concat(F.lit("L"), "ticker"), "market_cap_source": F.lit("marcap"), "is_estimated": F.lit(False)})
    _put(lake, P.latest(df, ["date", "ticker"], F.col("market_cap").desc_nulls_last(), F.col("close").desc_nulls_last()), "silver.market_caps", "date")


def build_prices(lake: Lake) -> None:
    sources = {name: lake.read(table) for name, table in SOURCES.items()}
    naver = P.latest(lake.read("bronze.naver_summary_raw").withColumnRenamed("snapshot_dt", "date"), ["date", "ticker"], F.col("market_cap").desc_nulls_last())
    _put(lake, P.silver_prices(sources, naver, lake.read("silver.market_caps")), "silver.prices", "date")


def build_identity(lake: Lake) -> None:
    prices = lake.read("silver.prices")
    master = I.security_master(prices, lake.read("bronze.dart_company_raw"))
    for name in ("gold.security_master", "silver.security_identity"):
        _put(lake, master, name)
    review = I.identity_review(prices).select("ticker", F.col("previous_date").alias("gap_start"), F.col("next_date").alias("gap_end"), F.col("previous_name").alias("name_before"), F.col("next_name").alias("name_after"), "name_changed")
    _put(lake, review, "gold.identity_review")
    master = lake.read("gold.security_master")
    relations = I.relation_spans(I.preferred_relations(master), prices).withColumnsRenamed({"valid_from": "first_seen_date", "valid_to": "last_seen_date"})
    _put(lake, relations, "silver.security_relations")
    _put(lake, I.universe_history(prices, master).join(prices.select("date", "security_id", "listing_id", "market", "is_halted", "is_designated", "is_liquidation_window"), ["date", "security_id"]), "gold.universe_history", "date")


def build_actions(lake: Lake) -> None:
    filings = lake.read("bronze.dart_filings_raw")
    actions = P.corroborate(P.share_jumps(lake.read("silver.prices")), filings)
    detected = actions.withColumnsRenamed({"factor": "adjustment_factor", "action_source": "source"})
    detected = _shape(detected, "silver.corporate_actions")
    stored = _shape(lake.read("silver.corporate_actions"), "silver.corporate_actions")
    _put(lake, P.merge_actions(stored, detected), "silver.corporate_actions", "effective_date")


def build_adjusted(lake: Lake) -> None:
    actions = lake.read("silver.corporate_actions").withColumnRenamed("adjustment_factor", "factor")
    _put(lake, P.adjusted_prices(lake.read("silver.prices"), actions), "gold.daily_prices_adj", "date")
    both = P.daily_market_caps(None, lake.read("silver.market_caps"), lake.read("silver.prices"))
    _put(lake, both.withColumn("security_id", F.concat(F.lit("S"), "ticker")), "gold.daily_market_caps", "date")
    relations = lake.read("silver.security_relations")
    d = P.preferred_discount(lake.read("silver.prices"), relations).join(F.broadcast(relations.select("common_security_id", "preferred_security_id", "preferred_ticker", "confidence")), ["common_security_id", "preferred_security_id"])
    _put(lake, d.withColumnsRenamed({"discount_mean": "discount_mean_252", "discount_std": "discount_std_252"}), "gold.preferred_discount", "date")


def build_holdings(lake: Lake) -> None:
    raw = lake.read("bronze.nps_holdings_raw").withColumnRenamed("rank", "source_rank")
    _put(lake, H.holdings_silver(raw, lake.read("gold.security_master")), "silver.nps_holdings", "date")
    held = lake.read("silver.nps_holdings")
    _put(lake, H.holdings_universe(held).withColumn("as_of", F.col("date")), "gold.nps_universe", "date")
    delta = H.holdings_delta(held).withColumnsRenamed({"date": "snapshot_date", "previous_date": "prev_snapshot_date", "current_ratio": "holding_ratio", "previous_ratio": "prev_holding_ratio"})
    _put(lake, delta.withColumn("ticker", F.expr("substring(security_id, 2)")), "gold.nps_holdings_delta", "snapshot_date")


def build_filings(lake: Lake) -> None:
    raw = lake.read("bronze.dart_filings_raw").withColumn("available_date", F.col("rcept_dt"))  # users compare strictly
    _put(lake, FI.filings_silver(raw), "silver.filings", "rcept_dt")
    _put(lake, FI.filing_events(lake.read("silver.filings")), "gold.filing_events", "event_date")


def build_fundamentals(lake: Lake) -> None:
    companies = P.latest(lake.read("bronze.dart_company_raw"), ["corp_code"], F.col("snapshot_dt").desc(), F.col("stock_code").desc_nulls_last())
    silver = FU.financials_silver(lake.read("bronze.dart_financials_raw"), companies)
    lake.write(silver, "silver.financials", "fiscal_year")
    snapshots = lake.read("gold.universe_history").where("is_active").select(F.col("date").alias("as_of_date"), "security_id").distinct()
    lake.write(FU.pit_intervals(lake.read("silver.financials"), snapshots).drop("fiscal_year"), "gold.fundamentals_pit", "as_of_date")


BUILDERS = (build_market_caps, build_prices, build_identity, build_actions, build_adjusted, build_filings, build_holdings, build_fundamentals)


def build_all(lake: Lake) -> list[str]:
    """Every builder in topological order; gives their names."""
    done = []
    for builder in BUILDERS:
        builder(lake)
        done.append(builder.__name__)
    return done
