from datetime import date

import pytest
from pyspark.sql import functions as F

from tessera.plans import pipeline
from tessera.sources import ingest, normalize
from tessera.sources.datasets import REGISTRY, Lake, request_hash
from tessera.sources.sandbox import Rejected, Sandbox, validate
from tessera.streaming import liveness


def test_empty_views(spark, tmp_path):
    assert len(REGISTRY) == 36
    table = Lake(spark, str(tmp_path)).register()
    assert table.where("has_files").count() == 0
    assert spark.table("gold_daily_prices_adj").columns == REGISTRY["gold.daily_prices_adj"].schema.names
    assert spark.table("analytics_daily_prices").count() == 0


def test_write_replaces_touched_partitions_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    row = lambda day, v: spark.createDataFrame([(date(2024, 1, day), "S1", v)], "date date, security_id string, close_adj double")
    lake.write(row(2, 1.0).unionByName(row(3, 2.0)), "gold.daily_prices_adj", "date")
    lake.write(row(3, 5.0), "gold.daily_prices_adj", "date")
    got = {r["date"].day: r["close_adj"] for r in lake.read("gold.daily_prices_adj").collect()}
    assert got == {2: 1.0, 3: 5.0} and lake.partition_dates("gold.daily_prices_adj") == ["2024-01-02", "2024-01-03"]
    assert lake.read_dates("gold.daily_prices_adj", ["2024-01-02"]).count() == 1
    with pytest.raises(FileExistsError):
        lake.write(row(3, 7.0), "gold.daily_prices_adj", "date", mode="fail")


def test_merge_keeps_the_new_row(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    row = lambda no, name: spark.createDataFrame([(no, date(2024, 1, 2), name)], "rcept_no string, rcept_dt date, report_nm string")
    lake.merge(row("1", "old").unionByName(row("2", "kept")), "silver.filings", ["rcept_no"], "rcept_dt")
    lake.merge(row("1", "new"), "silver.filings", ["rcept_no"], "rcept_dt")
    assert {r["rcept_no"]: r["report_nm"] for r in lake.read("silver.filings").collect()} == {"1": "new", "2": "kept"}


def test_request_hash_ignores_order():
    assert request_hash({"a": 1, "b": 2}) == request_hash({"b": 2, "a": 1}) != request_hash({"a": 1})


@pytest.mark.parametrize("sql", ["DROP TABLE x", "SELECT 1; SELECT 2", "INSERT INTO t SELECT 1", "WITH x AS (SELECT 1) DELETE FROM t", "SELECT * FROM parquet.`/tmp`", "SELECT 'open", "", "SHOW TABLES"])
def test_rejected_sql(sql):
    with pytest.raises(Rejected):
        validate(sql)


def test_sandbox(spark):
    spark.range(10).createOrReplaceTempView("numbers")
    box = Sandbox(spark, {"numbers"})
    answer = box.query("WITH n AS (SELECT id FROM numbers WHERE 'drop; table' <> '') SELECT * FROM n ORDER BY id", max_rows=3)
    assert answer.rows == [[0], [1], [2]] and answer.truncated
    with pytest.raises(Rejected):
        box.query("SELECT * FROM other_view")


def test_normalisers(spark):
    raw = spark.createDataFrame([("5930", "1,000", "-", "900", "N/A")], "ISU_SRT_CD string, TDD_CLSPRC string, TDD_HGPRC string, TDD_LWPRC string, ACC_TRDVOL string")
    r = normalize.krx_daily(raw, "2024-01-02").first()
    assert (r["ticker"], r["close"], r["high"], r["volume"]) == ("005930", 1000.0, None, None)
    raw = spark.createDataFrame([("005930", "A", "하락 1,200", "12", "3")], "ticker string, name string, change_text string, market_cap string, listed_shares string")
    r = normalize.naver_summary(raw, "2024-01-02").first()
    assert (r["change_abs"], r["market_cap"], r["listed_shares"]) == (-1200, 1_200_000_000, 3_000)


def test_ingest_goes_on_after_a_failure(spark, tmp_path):
    class Source:
        def pending(self, lake):
            return [ingest.Unit("bronze.krx_daily_raw", "a"), ingest.Unit("bronze.krx_daily_raw", "b")]

        def fetch(self, unit):
            if unit.key == "a":
                raise RuntimeError("down")
            return spark.createDataFrame([(date(2024, 1, 2), "000001")], "date date, ticker string")

        def date_column(self):
            return "date"

    got = ingest.run([Source()], Lake(spark, str(tmp_path)))
    assert [(r.status, r.rows) for r in got] == [("skipped", 0), ("written", 1)]


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ingest.TemporaryFailure
        return 7

    assert ingest.with_retries(flaky, sleep=lambda _: None) == 7 and len(calls) == 3


def test_build_all(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    px = spark.createDataFrame([(date(2024, 1, k), "000010", "Corp", "KOSPI", float(c), float(c), float(c), float(c), 10) for k, c in ((2, 100), (3, 110))], "date date, ticker string, name string, market string, open double, high double, low double, close double, volume long")
    lake.write(px, "bronze.krx_daily_raw", "date")
    co = spark.createDataFrame([(date(2024, 1, 1), "C1", "Corp", "000010")], "snapshot_dt date, corp_code string, corp_name string, stock_code string")
    lake.write(co, "bronze.dart_company_raw", "snapshot_dt")
    fin = spark.createDataFrame([("C1", date(2023, 12, 31), date(2024, 1, 2), date(2024, 1, 2), "11011", "assets", 1000.0, True)], "corp_code string, fiscal_period_end date, rcept_dt date, available_date date, report_type string, account_id string, amount double, is_consolidated boolean")
    lake.write(fin, "bronze.dart_financials_raw", "rcept_dt")
    assert len(pipeline.build_all(lake)) == len(pipeline.BUILDERS)
    gold = {r["date"].day: r["return_1d"] for r in lake.read("gold.daily_prices_adj").collect()}
    assert gold[2] is None and gold[3] == pytest.approx(0.1)
    pit = lake.read("gold.fundamentals_pit").collect()
    assert [(r["as_of_date"].day, r["amount"]) for r in pit] == [(3, 1000.0)]


def test_stream_counts(spark, tmp_path):
    rows = [(f"2024-01-0{k} 10:00:00", "click", 1.0) for k in (1, 1, 2)]
    df = spark.createDataFrame(rows, "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value")
    df.write.parquet(str(tmp_path / "in"))
    counts = liveness.windowed_counts(liveness.read_events(spark, str(tmp_path / "in"), "ts timestamp, event_type string, value double"))
    q = counts.writeStream.outputMode("complete").format("memory").queryName("liveness").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r["start"].day: r["n"] for r in spark.table("liveness").collect()} == {1: 2, 2: 1}


def test_sandbox_judges_the_analysed_plan(spark):
    from tessera.sources.sandbox import Rejected, Sandbox

    spark.range(3).createOrReplaceTempView("open_rows")
    spark.range(5).createOrReplaceTempView("secret")
    box = Sandbox(spark, {"open_rows"})
    assert box.query("WITH x AS (SELECT id FROM open_rows) SELECT count(*) AS n FROM x").rows == [[3]]
    assert box.query("SELECT 'it''s; -- /* fine' AS t, id FROM open_rows WHERE id IN (SELECT max(id) FROM open_rows)").rows == [["it's; -- /* fine", 2]]
    for sql in (
        "WITH x AS (SELECT * FROM secret), secret AS (SELECT 1) SELECT * FROM x", "SELECT * FROM open_rows WHERE id IN (SELECT id FROM secret)", "SELECT (SELECT max(id) FROM secret) AS m",
        "SELECT * FROM open_rows UNION ALL SELECT * FROM secret", "SELECT 1; SELECT 2", "DROP VIEW open_rows", "SELECT /* open", "SELECT * FROM parquet.`/tmp/x`",
    ):
        with pytest.raises(Rejected):
            box.plan(sql)
    wide = box.query("SELECT repeat('x', 400000) AS t FROM open_rows")
    assert wide.truncated and len(wide.rows) == 2
    assert box.query("SELECT id FROM open_rows", max_rows=2).truncated
