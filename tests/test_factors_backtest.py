import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import backtest as BT
from tessera.operators import factors as FA


def d(text):
    return date.fromisoformat(text)


def scores(df):
    return {(str(r["date"]), r["security_id"]): r["score"] for r in df.collect()}


def test_registry():
    assert len(FA.names()) == 15 - 1
    with pytest.raises(KeyError):
        FA.register(FA.get("quality_roa"))


def test_earnings_yield_prefers_owners(spark):
    pit = spark.createDataFrame([
        (d("2024-01-02"), "S001", "ifrs-full_ProfitLossAttributableToOwnersOfParent", 90.0, "11011"), (d("2024-01-02"), "S001", "ifrs-full_ProfitLoss", 100.0, "11011"), (d("2024-01-02"), "S002", "ifrs-full_ProfitLoss", 50.0, "annual"),
        (d("2024-01-02"), "S003", "net_income", 30.0, "11011"), (d("2024-01-02"), "S004", "net_income", 30.0, "11013"),
    ], "as_of_date date, security_id string, account_id string, amount double, report_type string")
    caps = spark.createDataFrame([(d("2024-01-02"), s, c) for s, c in (("S001", 1000), ("S002", 500), ("S003", 200), ("S004", 100))], "date date, security_id string, market_cap long")
    got = scores(FA.get("value_earnings_yield").compute({FA.PIT: pit, FA.PRICES: caps}))
    assert got == {("2024-01-02", "S001"): 0.09, ("2024-01-02", "S002"): 0.1, ("2024-01-02", "S003"): 0.15}


def test_dividend_yield_as_of(spark):
    div = spark.createDataFrame([("S001", d("2023-12-31"), d("2024-03-15"), 500.0, "11011"), ("S001", d("2023-12-31"), d("2024-04-01"), 600.0, "11011")], "security_id string, fiscal_period_end date, available_date date, cash_dividend_per_share double, report_type string")
    px = spark.createDataFrame([(d(x), "S001", 100, 1_000_000) for x in ("2024-03-15", "2024-03-16", "2024-04-02", "2025-06-15")], "date date, security_id string, listed_shares long, market_cap long")
    got = scores(FA.get("value_dividend_yield").compute({"silver.dividends": div, FA.PRICES: px}))
    assert list(got.values()) == [None, 0.05, 0.06, None] or got == {("2024-03-15", "S001"): None, ("2024-03-16", "S001"): 0.05, ("2024-04-02", "S001"): 0.06, ("2025-06-15", "S001"): None}


def test_buyback_decay(spark):
    ev = spark.createDataFrame([("S001", d("2024-03-15"), "buyback")], "security_id string, available_date date, event_type string")
    px = spark.createDataFrame([(d(x), "S001") for x in ("2024-03-15", "2024-03-16", "2024-04-05", "2024-06-15", "2024-06-16")], "date date, security_id string")
    got = scores(FA.get("event_buyback").compute({"gold.filing_events": ev, FA.PRICES: px}))
    want = [None, math.exp(-1 / 21), math.exp(-1), math.exp(-92 / 21), None]
    for (_, value), w in zip(sorted(got.items()), want, strict=True):
        assert value is None if w is None else value == pytest.approx(w)


DAYS = [date(2024, 1, 2) + timedelta(k) for k in range(70) if (date(2024, 1, 2) + timedelta(k)).weekday() < 5]


def _world(spark, gap=None):
    px = [(x, s, r) for k, x in enumerate(DAYS) for s, r in (("S001", 0.01), ("S002", -0.02), ("S003", 0.0)) if not (gap and s == gap[0] and x > gap[1])]
    prices = spark.createDataFrame(px, "date date, security_id string, return_1d double")
    uni = spark.createDataFrame([(x, s, True, "preferred" if s == "S003" else "common", False) for x in DAYS for s in ("S001", "S002", "S003")], "date date, security_id string, is_active boolean, share_class string, is_spac_pre boolean")
    sc = spark.createDataFrame([(x, s, v) for x in DAYS for s, v in (("S001", 2.0), ("S002", 1.0), ("S003", 9.0))], "date date, security_id string, score double")
    return prices, uni, sc


def test_nav_is_the_product_of_net_returns(spark):
    prices, uni, sc = _world(spark)
    c = BT.BacktestConfig("2024-01-02", "2024-03-08", top_fraction=1.0, max_position_weight=0.5)
    axis = spark.createDataFrame([(x, k) for k, x in enumerate(DAYS, 1)], "date date, day_index long")
    r = BT.run(sc, uni, prices, c, cost_model=BT.KoreanCosts(), axis=axis)
    book = r.ledger.orderBy("k").collect()
    assert [x["turnover"] for x in book] == [1.0] + [0.0] * (len(book) - 1) and book[0]["entry_cost"] == pytest.approx(0.0005)
    nav, want = r.nav.orderBy("date").collect(), 1.0
    for x in nav:
        gross = 0.5 * 0.01 - 0.5 * 0.02 if x["date"] > book[0]["entry_date"] else 0.0
        want *= 1 + gross - (0.0005 if x["date"] == book[0]["entry_date"] else 0.0)
        assert x["nav"] == pytest.approx(want, abs=1e-12)
    assert {x["security_id"] for x in r.positions.select("security_id").distinct().collect()} == {"S001", "S002"}


def test_missing_price_hits_once(spark):
    prices, uni, sc = _world(spark, ("S002", DAYS[24]))
    axis = spark.createDataFrame([(x, k) for k, x in enumerate(DAYS, 1)], "date date, day_index long")
    c = BT.BacktestConfig("2024-01-02", str(DAYS[40]), top_fraction=1.0, max_position_weight=0.5, missing_return=-0.3)
    plan = BT.schedules(axis, c)
    chosen = BT.targets(sc, uni, plan, c, 1)
    a = BT.attribute(BT.positions(chosen, plan, axis), prices, c).where("security_id = 'S002' AND missing").orderBy("date").collect()
    first = [x for x in a if x["k"] == a[0]["k"]]
    assert first[0]["contribution"] == pytest.approx(-0.15) and all(x["contribution"] == 0 for x in first[1:])


def test_direction_and_nan(spark):
    _, uni, _ = _world(spark)
    sc = spark.createDataFrame([(x, s, v) for x in DAYS for s, v in (("S001", 1.0), ("S002", float("nan")))], "date date, security_id string, score double")
    axis = spark.createDataFrame([(x, k) for k, x in enumerate(DAYS, 1)], "date date, day_index long")
    c = BT.BacktestConfig("2024-01-02", "2024-03-08", top_fraction=0.25)
    got = BT.targets(sc, uni, BT.schedules(axis, c), c, -1).select("security_id").distinct().collect()
    assert [x["security_id"] for x in got] == ["S001"]


def test_bad_config():
    with pytest.raises(ValueError):
        BT.BacktestConfig("2024-01-02", "2024-03-08", top_fraction=0.0)
