import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tessera.operators import analysis as A
from tessera.operators import cross_section as X

D = date(2024, 1, 2)


def frame(spark, values, day=D):
    return spark.createDataFrame([(day, f"S{k:03d}", None if v is None else float(v)) for k, v in enumerate(values)], "date date, security_id string, x double")


def values(df, column="x"):
    return [r[column] for r in df.orderBy("date", "security_id").collect()]


def test_winsorize_keeps_nulls(spark):
    assert values(X.winsorize(frame(spark, [1, 2, 3, 4, 100]), "x", 0.25, 0.75)) == [2, 2, 3, 4, 4]
    assert values(X.winsorize(frame(spark, [1, None, 3]), "x"))[1] is None


def test_zscore(spark):
    assert values(X.zscore(frame(spark, [1, 2, 3]), "x")) == [-1, 0, 1]
    assert values(X.zscore(frame(spark, [10, 20]), "x")) == pytest.approx([-math.sqrt(0.5), math.sqrt(0.5)])
    assert values(X.zscore(frame(spark, [5, 5]), "x")) == [None, None]


def test_rank_pct(spark):
    assert values(X.rank_pct(frame(spark, [10, 20, 30, 40]), "x")) == [0.25, 0.5, 0.75, 1]
    assert values(X.rank_pct(frame(spark, [10, 10, 20, None]), "x")) == [0.5, 0.5, 1, None]


def test_neutralize(spark):
    df = frame(spark, [1, 3, 10]).withColumn("market", F.when(F.col("x") < 5, "A").otherwise("B"))
    assert values(X.neutralize(df, "x", ["market"])) == [-1, 1, 0]


@pytest.mark.parametrize(("xs", "n", "want"), [(range(1, 11), 5, [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]), ([5, 15, 25], 5, [0, 1, 3]), ([5, 5, 7], 2, [0, 0, 1])])
def test_buckets(spark, xs, n, want):
    assert values(X.quantile_bucket(frame(spark, xs), "x", n), "bucket") == want


def test_forward_returns(spark):
    p = spark.createDataFrame([(date(2024, 1, d), "S1", c) for d, c in ((2, 100.0), (3, 110.0), (4, 121.0))], "date date, security_id string, close_adj double")
    assert values(A.forward_returns(p, 1), "forward_return") == [pytest.approx(0.1), pytest.approx(0.1), None]
    assert values(A.forward_returns(p, 2), "forward_return")[0] == pytest.approx(0.21)
    with pytest.raises(ValueError):
        A.forward_returns(p, 0)


def _ic_tables(spark, scores, returns):
    s = spark.createDataFrame([(D, f"S{k}", float(v)) for k, v in enumerate(scores)], "date date, security_id string, score double")
    r = spark.createDataFrame([(D, f"S{k}", float(v)) for k, v in enumerate(returns)], "date date, security_id string, forward_return double")
    return s, r


def test_information_coefficient(spark):
    s, r = _ic_tables(spark, [1, 2, 3, 4], [0.01, 0.03, 0.02, 0.04])
    row = A.information_coefficient(s, r).first()
    assert row["ic"] == pytest.approx(0.8) and row["n"] == 4
    s, r = _ic_tables(spark, [1, 2, 3, float("nan")], [1, 2, 3, 9])
    row = A.information_coefficient(s, r, "pearson").first()
    assert row["ic"] == pytest.approx(1.0) and row["n"] == 3
    with pytest.raises(ValueError):
        A.information_coefficient(s, r, "kendall")


def test_quantile_returns(spark):
    s, r = _ic_tables(spark, [1, 2, 3, 4], [0.01, 0.02, 0.03, 0.05])
    got = {x["quantile"]: (x["mean_return"], x["n"]) for x in A.quantile_returns(s, r, 2).collect()}
    assert got == {1: (pytest.approx(0.015), 2), 2: (pytest.approx(0.04), 2)}
