"""What keeps the point-in-time reports and the backtests whole on large tables."""

import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.plans.bridge import BASE, Bridge, ctes
from tessera.plans.fundamentals import pit_intervals, pit_naive, pit_totals

ROOT = Path(__file__).resolve().parents[1]


def _fin(spark):
    day = lambda m, d=1: date(2024, m, d)
    rows = [
        ("S1", "a", day(1), "11011", 10.0, day(1, 5), "1"), ("S1", "a", day(2), "11011", 20.0, day(2, 5), "2"), ("S1", "b", day(1), "11011", None, day(1, 20), "3"),
        ("S1", "b", day(1), "11014", -7.0, day(3, 5), "4"), ("S1", "a", day(1), "11011", 11.0, day(4, 5), "5"), ("S2", "a", day(1), "11011", None, day(1, 1), "6"),
        ("S2", "c", day(1), "11014", 3.0, day(6, 5), "7"), ("S2", "c", day(1), "11014", 4.0, day(6, 5), "8"), (None, "a", day(1), "11011", 9.0, day(1, 1), "9"), ("S3", "a", day(1), "annual", 5.0, day(2, 2), "10"),
    ]
    return spark.createDataFrame(rows, "security_id string, account_id string, fiscal_period_end date, report_type string, amount double, available_date date, rcept_no string")


def _days(spark, per_security: bool):
    days = [date(2024, 1, 2), date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 20), date(2024, 2, 5), date(2024, 2, 6), date(2024, 3, 1), date(2024, 3, 9), date(2024, 4, 6), date(2024, 6, 6), None]
    if not per_security:
        return spark.createDataFrame([(d,) for d in days], "as_of_date date")
    rows = [("S1", d) for d in days if d and d.day != 6] + [("S2", d) for d in days] * 2 + [("S9", days[0]), (None, days[1])]
    return spark.createDataFrame(rows, "security_id string, as_of_date date")


def _shuffled(df) -> list[str]:
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("per_security", [True, False])
def test_pit_totals_are_the_sums_of_pit_naive(spark, per_security):
    fin, days = _fin(spark), _days(spark, per_security)
    annual = (F.col("report_type") == "11011").alias("kind")
    naive = pit_naive(fin, days.where("as_of_date IS NOT NULL").distinct())
    want = naive.groupBy("as_of_date", "security_id", annual).agg(F.count("*").alias("n"), F.sum(F.col("amount").cast("long")).alias("total"))
    got = pit_totals(fin, days, annual, F.col("amount").cast("long"))
    assert got.count() and sorted(map(str, got.collect())) == sorted(str(r).replace(" n=", " n_accounts=") for r in want.collect())
    columns = ["as_of_date", "security_id", "account_id", "period_scope", "rcept_no"]
    assert sorted(map(str, pit_intervals(fin, days).select(columns).collect())) == sorted(map(str, naive.select(columns).collect()))


@pytest.mark.parametrize("name", ["fundamentals_pit", "fundamentals_pit_interval"])
def test_nothing_spread_over_days_is_shuffled_in_the_reports(spark, name):
    from tessera.queries import QUERIES

    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert _shuffled(df) and not [line for line in _shuffled(df) if "as_of_date" in line.split("ENSURE")[0] and "security_id" in line]


def test_views_with_their_own_plans_have_the_rows_of_their_sql(spark, tmp_path):
    for name in BASE:
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet") if name != "lineitem" else None
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    gap = F.col("l_orderkey") % 3 == 0  # days without a price
    lines.withColumn("l_discount", F.when(~gap, F.col("l_discount"))).withColumn("l_quantity", F.when(~gap, F.col("l_quantity"))).withColumn("l_suppkey", F.when(F.col("l_orderkey") % 50 != 0, F.col("l_suppkey"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    b = Bridge(spark, str(tmp_path))
    for name in ("axis", "filled"):
        own, sql = b(name), spark.sql(f"{ctes(name)} SELECT * FROM {name}")
        assert own.columns == sql.columns and [t for _, t in own.dtypes] == [t for _, t in sql.dtypes]
        assert own.count() == sql.count() and own.exceptAll(sql).isEmpty()
    assert not [line for line in _shuffled(b("filled")) if "date#" in line and "security_id#" in line]


@pytest.mark.parametrize("query", ["backtest_nav", "backtest_summary"])
def test_backtest_is_the_first_query_of_a_session(query):
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from tessera.queries import QUERIES
print("rows", len(QUERIES["{query}"](spark, "/root/testdata/sf0.001").collect()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=240)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_backtest_reads_only_the_days_it_needs(spark):
    from tessera.operators import backtest as BT
    from tessera.operators import factors as FA
    from tessera.plans.bridge import filled_on, quotes, universe_on
    from tessera.queries.core import CONFIG

    b = Bridge(spark, "/root/testdata/sf0.001")
    days = b("axis").where("day_index % 97 = 1 OR day_index IN (400, 401) OR day_index = 1")
    asked = days.select("day_index").union(spark.sql("SELECT -5L"))
    some, index = filled_on(b, asked), [r.day_index for r in days.collect()]
    same = lambda x, y: x.count() == y.count() > 0 and x.exceptAll(y).isEmpty()
    assert same(some, b("filled").where(F.col("day_index").isin(index)))
    assert same(universe_on(b, asked), b("universe").join(days.select("date"), "date", "left_semi").select(b("universe").columns))
    dense = FA.get("momentum_12_1").compute({FA.PRICES: b("px_dense")}).join(days.select("date"), "date", "left_semi").where("score IS NOT NULL")
    assert same(FA.momentum_on(days, lambda d: filled_on(b, d)).where("score IS NOT NULL").select(dense.columns), dense)
    # holdings before a security's first price, on days with and without one
    held = b("axis").join(b("px").select("security_id").distinct().limit(6)).where("day_index < 900").select("date", "security_id", F.lit(0.1).alias("weight"), F.when(F.col("day_index") < 450, 1).otherwise(2).alias("k"))
    held = held.withColumn("signal_date", F.col("date")).withColumn("entry_date", F.col("date"))
    c = BT.BacktestConfig("1992-01-01", "2001-06-29", missing_return=-0.3, drop_after_missing=False)
    a, z = BT.attribute(held, quotes(b), c), BT.attribute(held, b("px_dense"), c)
    assert z.where("missing").count() and same(a.select(sorted(a.columns)), z.select(sorted(z.columns)))


def test_backtest_spreads_prices_over_asked_days_only(spark):
    from tessera.queries import QUERIES

    df = QUERIES["backtest_summary"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    spread = [line for line in (plan + df._jdf.queryExecution().withCachedData().toString()).splitlines() if "explode(sequence(first" in line]
    assert not spread
