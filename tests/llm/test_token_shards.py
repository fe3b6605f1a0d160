"""Packed ids go to their shard in one shuffle; no table of them is written beside the files."""

from tessera.llm import common, queries, token_files


def test_no_table_of_ids_beside_the_shards(spark, tmp_path, monkeypatch):
    rows = [(None if k % 7 == 0 else k // 2, f"word{k} again and again " * (k % 5)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    written, table = [], common.Scratch.table
    monkeypatch.setattr(common.Scratch, "table", lambda self, df, *a, **b: written.append(df.schema) or table(self, df, *a, **b))
    shards = token_files.write_shards(docs, f"file://{tmp_path}/s", queries.vocabulary(queries.WORD_BPE), 2, shards=6)
    assert not [f for schema in written for f in schema if f.dataType.simpleString() in ("binary", "string")]
    assert 1 < len(shards) <= 6 and [s[0] for s in shards] == list(range(len(shards)))
    held = [list(token_files.ShardReader(s[3]).documents()) for s in shards]
    ids = [doc for shard in held for doc, _, _ in shard]
    assert sorted(ids, key=lambda x: (x is not None, x or 0)) == ids and len(ids) == len(rows)
    start = 0
    for (_, begin, n, _), shard in zip(shards, held, strict=True):
        assert begin == start and n == sum(len(x) for _, _, x in shard)
        start += n
