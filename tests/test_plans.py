import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators.asof import asof
from tessera.plans import filings as FI
from tessera.plans import fundamentals as FU
from tessera.plans import holdings as H
from tessera.plans import identity as I
from tessera.plans import macro as M
from tessera.plans import prices as P


def d(text):
    return date.fromisoformat(text)


def test_number_and_zfill(spark):
    row = spark.createDataFrame([("1,234.5", "-", "N/A", "", "x", "1234567", "12")], "a string, b string, c string, d string, e string, f string, g string")
    got = row.select(*[X.number(F.col(c)) for c in "abcde"], X.zfill(F.col("f"), 6), X.zfill(F.col("g"), 6)).first()
    assert tuple(got) == (1234.5, None, None, None, None, "1234567", "000012")


def test_dedup_by_continuity(spark):
    rows = [("2024-01-02", 100.0, 1), ("2024-01-03", 20.0, 5), ("2024-01-03", 101.0, 99), ("2024-01-04", 105.0, 1)]
    c = spark.createDataFrame([(d(a), "123456", "naver", b, v) for a, b, v in rows], "date date, ticker string, source string, close double, volume long")
    got = {r["date"]: r["volume"] for r in P.dedup_candidates(c).collect()}
    assert got == {d("2024-01-02"): 1, d("2024-01-03"): 99, d("2024-01-04"): 1}


def _split(spark):
    rows = [(2, 10000.0, 1_000_000, 1.0e10), (3, 10100.0, 1_000_000, 1.01e10), (4, 2020.0, 5_000_000, 1.01e10), (5, 2040.0, 5_000_000, 1.02e10)]
    return spark.createDataFrame([(date(2024, 1, k), "S1", "000001", c, s, m, 10, "raw", "krx") for k, c, s, m in rows], "date date, security_id string, ticker string, close double, listed_shares long, market_cap double, volume long, price_basis string, price_source string")


def test_split_and_adjustment(spark):
    p = _split(spark)
    actions = P.share_jumps(p)
    (a,) = actions.collect()
    assert (a["effective_date"], a["action_type"], a["confidence"]) == (d("2024-01-04"), "split", "medium") and a["factor"] == pytest.approx(0.2)
    got = P.adjusted_prices(p, actions).orderBy("date").collect()
    assert got[0]["close_adj"] == pytest.approx(2000) and got[2]["close_adj"] == pytest.approx(2020)
    assert got[0]["return_1d"] is None and got[2]["return_1d"] == pytest.approx(0)


def test_preferred_relations(spark):
    rows = [("005930", "삼성전자"), ("005935", "삼성전자우"), ("111110", "Common Corp"), ("111115", "Unrelated 우"), ("123450", "Test"), ("12345K", "Test 2우B"), ("222220", "Alone")]
    names = spark.createDataFrame([("S" + t, t, n) for t, n in rows], "security_id string, ticker string, name string")
    got = {r["preferred_ticker"]: r["confidence"] for r in I.preferred_relations(names).collect()}
    assert got == {"005935": "high", "111115": "low", "12345K": "high"}


def test_preferred_discount(spark):
    rows = [(k, s, c) for k, pref in enumerate((50.0, 60.0, 40.0, 50.0), 2) for s, c in (("C", 100.0), ("P", pref))]
    p = spark.createDataFrame([(date(2024, 1, k), s, c) for k, s, c in rows], "date date, security_id string, close double")
    r = spark.createDataFrame([("C", "P")], "common_security_id string, preferred_security_id string")
    got = P.preferred_discount(p, r, 3, 2).orderBy("date").collect()
    assert [x["discount"] for x in got] == pytest.approx([0.5, 0.4, 0.6, 0.5])
    assert got[0]["discount_mean"] is None and [x["discount_mean"] for x in got[1:]] == pytest.approx([0.45, 0.5, 0.5])
    assert [x["discount_z"] for x in got[1:]] == pytest.approx([-math.sqrt(0.5), 1, 0])


def test_ticker_reuse(spark):
    axis = [("AXIS00", k, "x") for k in range(1, 13)]
    rows = [("222222", 1, "Old Corp"), ("222222", 2, "Old Corp"), ("222222", 12, "New Corp"), *axis]
    df = spark.createDataFrame([(t, date(2024, 1, k), n) for t, k, n in rows], "ticker string, date date, name string")
    (r,) = I.identity_review(df, 5).collect()
    assert (r["previous_date"], r["next_date"], r["previous_name"], r["next_name"], r["name_changed"]) == (d("2024-01-02"), d("2024-01-12"), "Old Corp", "New Corp", True)


FIN = "security_id string, account_id string, fiscal_period_end date, report_type string, available_date date, is_consolidated boolean, amount double"


@pytest.mark.parametrize("build", [FU.pit_naive, FU.pit_intervals])
def test_pit_is_strict(spark, build):
    rows = [
        ("S1", "assets", d("2022-12-31"), "11011", d("2023-03-15"), True, 1000.0), ("S1", "assets", d("2023-12-31"), "11011", d("2024-01-02"), True, 2000.0),
        ("S1", "profit", d("2023-12-31"), "11011", d("2024-01-02"), True, 300.0), ("S1", "profit", d("2023-12-31"), "11011", d("2024-01-03"), True, 310.0),
        ("S1", "equity", d("2022-12-31"), "11011", d("2023-03-15"), False, 111.0), ("S1", "equity", d("2022-12-31"), "11011", d("2023-03-15"), True, 222.0),
    ]
    days = spark.createDataFrame([(d("2024-01-02"),), (d("2024-01-03"),)], "as_of_date date")
    got = {(r["as_of_date"].day, r["account_id"]): r["amount"] for r in build(spark.createDataFrame(rows, FIN), days).collect()}
    assert got == {(2, "assets"): 1000, (2, "equity"): 222, (3, "assets"): 2000, (3, "profit"): 300, (3, "equity"): 222}


def test_intervals_ignore_late_corrections_of_old_periods(spark):
    rows = [("S1", "a", d("2023-12-31"), "11011", d("2024-03-01"), True, 2.0), ("S1", "a", d("2022-12-31"), "11011", d("2024-04-01"), True, 1.0), ("S1", "a", d("2023-12-31"), "11011", d("2024-05-01"), True, 3.0)]
    days = spark.createDataFrame([(d("2024-03-01") + timedelta(k),) for k in range(0, 90, 7)], "as_of_date date")
    f = spark.createDataFrame(rows, FIN)
    key = lambda df: sorted((r["as_of_date"], r["amount"]) for r in df.collect())
    assert key(FU.pit_naive(f, days)) == key(FU.pit_intervals(f, days))


def test_holdings_delta(spark):
    rows = [("2024-03-31", "A", 7.5), ("2024-03-31", "B", 3.0), ("2024-06-30", "A", 8.1), ("2024-06-30", "C", 2.0)]
    h = spark.createDataFrame([(d(a), b, c) for a, b, c in rows], "date date, security_id string, ownership_pct double")
    got = {r["security_id"]: (round(r["delta_ratio"], 6), r["entered"], r["exited"], r["available_date"]) for r in H.holdings_delta(h).collect()}
    day = d("2024-07-07")
    assert got == {"A": (0.6, False, False, day), "B": (-3.0, False, True, day), "C": (2.0, True, False, day)}


def test_event_titles(spark):
    titles = {
        "주요사항보고서(자기주식취득결정)": "buyback", "자기주식취득 신탁계약 체결 결정": "buyback", "주요사항보고서(자기주식처분결정)": "buyback_disposal", "[기재정정]주요사항보고서(유상증자결정)": "rights_issue", "무상증자 결정": "bonus_issue",
        "전환사채권발행결정": "convertible_bond", "감자결정": "capital_reduction", "주식분할결정": "stock_split", "주식병합결정": "stock_merge", "회사합병결정": "merger", "회사분할결정": "merger", "현금ㆍ현물배당결정": "dividend",
        "최대주주변경": "major_holder_change", "단일판매ㆍ공급계약체결": "supply_contract", "횡령ㆍ배임혐의발생": "embezzlement", "관리종목지정": "delisting_risk", "사업보고서 (2023.12)": None,
    }
    df = spark.createDataFrame([(t,) for t in titles], "t string").select("t", FI.event_type(FI.bare_title(F.col("t"))).alias("e"))
    assert {r["t"]: r["e"] for r in df.collect()} == titles


def test_corrections_fold(spark):
    rows = [("1", "2024-01-05", "자기주식취득결정"), ("2", "2024-01-20", "[기재정정]자기주식취득결정"), ("3", "2024-06-03", "자기주식취득결정")]
    f = spark.createDataFrame([(n, d(t), d(t), "S1", "000001", r, False) for n, t, r in rows], "rcept_no string, rcept_dt date, available_date date, security_id string, stock_code string, report_nm string, is_correction boolean")
    assert [r["event_date"] for r in FI.filing_events(f).orderBy("event_date").collect()] == [d("2024-01-05"), d("2024-06-03")]


def test_event_study(spark):
    days = [date(2024, 1, 1) + timedelta(k) for k in range(40)]
    special = {("A", 10): 0.04, ("A", 11): 0.02, ("B", 20): -0.02}
    prices = spark.createDataFrame([(x, s, special.get((s, k), 0.01)) for k, x in enumerate(days) for s in "ABC"], "date date, security_id string, return_1d double")
    events = spark.createDataFrame([("A", days[9]), ("B", days[19])], "security_id string, available_date date")
    by_day, summary = FI.event_study(events, prices, 2, 3, min_events=2)
    got = {r["rel_day"]: r for r in by_day.collect()}
    assert got[0]["mean_ar"] == pytest.approx(0) and got[1]["mean_ar"] == pytest.approx((0.02 - 0.04 / 3) / 2)
    row = summary.first()
    assert row["n_events"] == 2 and row["hit_rate"] == 0.5
    with pytest.raises(ValueError):
        FI.event_study(events, prices, 2, 3, min_events=3)


def test_asof(spark):
    left = spark.createDataFrame([("A", d("2024-01-10")), ("A", d("2024-02-20")), ("B", d("2024-01-10"))], "k string, t date")
    right = spark.createDataFrame([("A", d("2024-01-05"), 1), ("A", d("2024-01-10"), 2)], "k string, u date, v int")
    by = lambda df: [r["v"] for r in df.orderBy("k", "t").collect()]
    assert by(asof(left, right, ["k"], "t", "u", ["v"])) == [2, 2, None]
    assert by(asof(left, right, ["k"], "t", "u", ["v"], tolerance_days=10, allow_equal=False)) == [1, None, None]
    assert by(asof(left, right, ["k"], "t", "u", ["v"], forward=True)) == [2, None, None]


def test_macro(spark):
    old = spark.createDataFrame([("A", d("2024-01-01"), 1.0), ("A", d("2024-02-01"), 2.0), ("A", d("2024-03-01"), 3.0), ("B", d("2024-02-01"), 9.0)], "series_id string, date date, value double")
    new = spark.createDataFrame([("A", d("2024-02-01"), 5.0), ("A", d("2024-03-01"), 6.0), ("A", d("2024-03-01"), 7.0)], "series_id string, date date, value double")
    got = sorted((r["series_id"], r["date"].month, r["value"]) for r in M.range_upsert(old, new).collect())
    assert got == [("A", 1, 1.0), ("A", 2, 5.0), ("A", 3, 7.0), ("B", 2, 9.0)]
    raw = spark.createDataFrame([("C", "S1", 2023, d("2024-03-01"), "주당 현금배당금(원)", "1,000", "900", "-")], "corp_code string, security_id string, fiscal_year int, available_date date, label string, thstrm string, frmtrm string, lwfr string")
    assert sorted((r["fiscal_year"], r["cash_dividend_per_share"]) for r in M.dividends_silver(raw).collect()) == [(2022, 900.0), (2023, 1000.0)]
