"""Rules whose expected rows are stated in words: types from names, corroborating filings, corrections, metrics, kept actions."""

from datetime import date

import pytest

from tessera.functions.exprs import rolling_std
from tessera.operators import calendar as C
from tessera.operators import serving as S
from tessera.plans import filings as FI
from tessera.plans import fundamentals as FU
from tessera.plans import identity as I
from tessera.plans import prices as P

d = date.fromisoformat


def test_types_from_names(spark):
    names = {
        "KODEX 200": "etf", "KBSTAR 200": "etf", "TRUE 인버스 ETN": "etn", "TRUE ETN": "etn", "신한알파리츠": "reit", "테스트스팩1호": "spac_pre", "Alpha SPAC": "spac_pre",
        "일반기업": "equity", "TIGERAIR": "equity", "KODEX": "equity", None: "equity",
    }
    df = spark.createDataFrame([(n,) for n in names], "name string").select("name", I.security_type(I.F.col("name")).alias("kind"))
    assert {r["name"]: r["kind"] for r in df.collect()} == names


def test_master_columns_and_merge(spark):
    day = [d("2024-01-02"), d("2024-01-03")]
    prices = spark.createDataFrame([("111111", x, "Split Corp", "KOSPI") for x in day], "ticker string, date date, name string, market string")
    companies = spark.createDataFrame([("111111", "2", "B", day[0]), ("111111", "1", "A", day[0])], "stock_code string, corp_code string, corp_name string, snapshot_dt date")
    row = I.security_master(prices, companies).first()
    assert (row["corp_code"], row["corp_name"], row["issuer_id"], row["isin"], row["delisting_reason"], row["last_seen"]) == ("1", "A", "I1", None, "unknown", day[1])


def test_filings_corroborate(spark):
    kinds = "security_id string, ticker string, effective_date date, action_type string, factor double, confidence string, action_source string"
    day = d("2024-01-03")
    actions = spark.createDataFrame([("S1", "111111", day, "split", 0.2, "medium", "shares_jump"), ("S2", "222222", day, "merge", 10.0, "medium", "shares_jump"), ("S3", "333333", day, "split", 0.5, "medium", "shares_jump"), ("S4", "444444", day, "split", 0.5, "medium", "shares_jump")], kinds)
    filings = spark.createDataFrame(
        [("111111", d("2023-12-20"), "n1", "액면분할 결정"), ("111111", d("2023-12-01"), "n0", "주식분할결정"), ("222222", d("2023-12-27"), "n2", "감자결정"), ("333333", d("2023-12-27"), "n3", "무상증자결정"), ("444444", d("2023-09-04"), "n4", "주식분할결정"), (None, day, "n5", "주식분할")],
        "stock_code string, rcept_dt date, rcept_no string, report_nm string",
    )
    got = {r["security_id"]: (r["action_type"], r["confidence"], r["source_rcept_no"]) for r in P.corroborate(actions, filings).collect()}
    assert got == {"S1": ("split", "high", "n1"), "S2": ("capital_reduction", "high", "n2"), "S3": ("split", "medium", None), "S4": ("split", "medium", None)}


def test_corrections_anywhere_in_the_tags(spark):
    rows = [("1", "2024-01-05", "자기주식취득결정"), ("2", "2024-01-20", " [첨부추가] [기재정정] 자기주식취득결정 "), ("3", "2024-06-03", "[첨부추가]자기주식취득결정")]
    f = spark.createDataFrame([(n, d(t), d(t), "S1", "000001", r, False) for n, t, r in rows], "rcept_no string, rcept_dt date, available_date date, security_id string, stock_code string, report_nm string, is_correction boolean")
    assert sorted(r["rcept_no"] for r in FI.filing_events(f).collect()) == ["1", "3"]
    described = FI.describe_event_patterns()
    assert [x["n_patterns"] for x in described if x["event_type"] == "buyback"] == [2, 2]


FIN = "security_id string, ticker string, account_id string, fiscal_period_end date, fiscal_year int, available_date date, report_type string, is_consolidated boolean, amount double, rcept_no string"


def _fin(spark, *rows):
    return spark.createDataFrame([("S1", "000001", a, d(end), int(end[:4]), d(seen), kind, True, x, seen + a) for a, end, seen, kind, x in rows], FIN)


def test_metrics_come_from_listed_accounts(spark):
    year = ("2023-12-31", "2024-03-20", "11011")
    f = _fin(spark, ("ifrs-full_Equity", *year, 100.0), ("ifrs-full_EquityAndLiabilities", *year, 300.0), ("ifrs-full_ProfitLoss", *year, 10.0), ("ifrs-full_ProfitLossBeforeTax", *year, 50.0), ("ifrs-full_Revenue", *year, 200.0), ("dart_OperatingIncomeLoss", *year, 20.0))
    prices = spark.createDataFrame([(d("2024-06-03"), "000001", "KOSPI", "equity", 10.0, 1000.0)], "date date, ticker string, market string, security_type string, close_adj double, market_cap double")
    names = spark.createDataFrame([("000001", "A")], "ticker string, name string")
    none = spark.createDataFrame([], "ticker string, available_date date, cash_dividend_yield_pct double")
    snap = spark.createDataFrame([], "ticker string, snapshot_dt date, per double, roe double")
    r = S.screener(prices, names, f, none, snap, "2024-06-30").first()
    assert (r["per"], r["pbr"], r["roe"], r["operating_margin"], r["equity"], r["as_of"]) == (100.0, 10.0, 10.0, 10.0, 100.0, "2024-06-30")
    b = S.basic_fundamentals(f, "2024-06-30").first()
    assert (b["equity"], b["net_income"], b["assets"]) == (100.0, 10.0, None)


@pytest.mark.parametrize("equity, want", [("ifrs-full_Equity", 60.0), ("ifrs-full_EquityAttributableToOwnersOfParent", 80.0)])
def test_equity_is_repaired_unless_it_is_the_owners(spark, equity, want):
    year = ("2023-12-31", "2024-03-20", "11011")
    f = _fin(spark, (equity, *year, 80.0), ("ifrs-full_Assets", *year, 100.0), ("ifrs-full_Liabilities", *year, 40.0))
    assert S.basic_fundamentals(f, "2024-06-30").first()["equity"] == want


def test_per_share(spark):
    income = "ifrs-full_ProfitLoss"
    f = _fin(spark, (income, "2023-12-31", "2024-03-20", "11011", 100.0), (income, "2023-03-31", "2023-05-15", "11013", 20.0), (income, "2024-03-31", "2024-05-15", "11013", 35.0), ("ifrs-full_Equity", "2023-12-31", "2024-03-20", "11011", 500.0))
    shares = spark.createDataFrame([("S1", 10)], "security_id string, shares long")
    r = S.per_share(f, shares, "2024-06-30").first()
    assert (r["bps"], r["eps_annual"], r["eps_ttm"]) == (50.0, 10.0, 11.5)
    said = f.unionByName(_fin(spark, ("ifrs-full_BasicEarningsLossPerShare", "2023-12-31", "2024-03-20", "11011", 9.5)))
    r = S.per_share(said, shares, "2024-06-30").first()
    assert (r["eps_annual"], r["eps_ttm"]) == (9.5, 9.5)


def test_korean_account_names(spark):
    names = {"자산총계": "ifrs-full_Assets", "부채 총계": "ifrs-full_Liabilities", "자본총계": "ifrs-full_Equity", "기본주당이익(손실) (단위 : 원)": "ifrs-full_BasicEarningsLossPerShare", "매출액": None}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", FU.account_of_name(I.F.col("n")).alias("a"))
    assert {r["n"]: r["a"] for r in df.collect()} == names


def test_manual_actions_stay(spark):
    kinds = "effective_date date, security_id string, factor double, source string"
    day = d("2024-01-03")
    stored = spark.createDataFrame([(day, "A", 2.0, "manual"), (day, "B", 0.5, "shares_jump"), (day, "C", 3.0, None)], kinds)
    found = spark.createDataFrame([(day, "A", 0.2, "shares_jump"), (day, "D", 0.1, "shares_jump")], kinds)
    got = sorted((r["security_id"], r["factor"]) for r in P.merge_actions(stored, found).collect())
    assert got == [("A", 2.0), ("C", 3.0), ("D", 0.1)]


def test_calendar_neighbours(spark):
    axis = spark.createDataFrame([(d("2024-01-02"), 1), (d("2024-01-03"), 2), (d("2024-01-05"), 3)], "date date, day_index long")
    days = spark.createDataFrame([(d(x),) for x in ("2024-01-01", "2024-01-03", "2024-01-04", "2024-01-06")], "date date")
    got = {str(r["date"])[-2:]: (r["is_open"], *(x and x.day for x in (r["previous"], r["next"]))) for r in C.neighbours(days, axis).collect()}
    assert got == {"01": (False, None, 2), "03": (True, 2, 5), "04": (False, 3, 5), "06": (False, 5, None)}


def test_rolling_deviation_equals_a_sliding_frame(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(0.01, 0.02, 60)
    values = [None if k % 9 == 4 else float(v) for k, v in enumerate(x)]
    df = spark.createDataFrame([("A", k, v) for k, v in enumerate(values)], "s string, t int, x double")
    got = [r["sd"] for r in rolling_std(df, "x", ["s"], "t", 10, 5, "sd").orderBy("t").collect()]
    for k, sd in enumerate(got):
        part = [v for v in values[max(0, k - 9) : k + 1] if v is not None]
        assert (sd is None) == (len(part) < 5) and (sd is None or sd == pytest.approx(np.std(part, ddof=1), rel=1e-9))
