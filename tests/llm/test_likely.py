"""Rows that a join would drop are dropped before their texts are shuffled."""

from pyspark.sql import functions as F

from tessera.llm import common, jaccard_join


def test_likely_rows(spark, tmp_path):
    rows = [(None if k % 11 == 0 else k // 2, k * 7919) for k in range(5000)]
    docs = spark.createDataFrame(rows, "a long, b long")
    wanted = [r for k, r in enumerate(rows) if k % 10 == 0]
    spark.createDataFrame(wanted, "x long, y long").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    for most, limit in ((1 << 28, 510), (1 << 20, 510)):
        got = [tuple(r) for r in common.likely(docs, ["a", "b"], table, ["x", "y"], most).collect()]
        assert set(wanted) <= set(got) <= set(rows) and len(got) == len(set(got)) <= limit
    assert common.likely(docs, ["a", "b"], table.limit(0), ["x", "y"]).count() == 0


def test_the_join_shuffles_few_texts(spark, monkeypatch):
    """Of 400 texts two are near copies; no more than these (and chance hits) are joined for their sets."""
    texts = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(400)] + [" ".join(["other", *[f"w7x{j}" for j in range(1, 60)]])]
    seen, sets = [], jaccard_join.shingle_sets
    monkeypatch.setattr(jaccard_join, "shingle_sets", lambda df, n: seen.append(df) or sets(df, n))
    out = jaccard_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "marks" in plan  # the texts pass a filter before they are joined
    assert {r.doc_id for r in out.where(F.col("n_links") > 0).collect()} == {7, 400}
