"""The queries of this folder: operator N with production parameters over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, compact_windows, decontaminate, exact_dedup, jaccard_join, langid, line_dedup, sharding, token_files, toxicity
from tessera.llm.common import documents

#: Where the vocabulary files lie; a parameter, since they belong to the box and not to the repository.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir, "doc_id", "text"), vocabulary(BYTE_BPE))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir, "doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(documents(spark, sf_dir, "doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir, "doc_id", "text")).drop("row")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(documents(spark, sf_dir, "doc_id", "text"), items)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(documents(spark, sf_dir, "doc_id", "text"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(documents(spark, sf_dir, "doc_id", "text"), vocabulary(WORD_BPE))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir, "doc_id", "text", "source"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, sf_dir, "doc_id", "text"), labels).drop("passages")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sharding": op4_sharding,
    "op5_decontaminate": op5_decontaminate,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_files": op7_token_files,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
}

OP2_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p + 1 : p + least(len(w), 10)], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS p FROM iw WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, p, n, array_to_string(w[p + 1 : p + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, p, n, g FROM grams SEMI JOIN win USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits JOIN win USING (n, g)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM lines),
bad AS (SELECT norm FROM keyed WHERE source IS NOT NULL AND regexp_matches(norm, '[\p{L}\p{N}]') GROUP BY norm HAVING count(DISTINCT source) >= (SELECT least(10, greatest(3, ceil(count(DISTINCT source) / 2))) FROM documents)),
done AS (
  SELECT doc_id, count(*) AS n_lines, count(b.norm) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE b.norm IS NULL), '') AS clean
  FROM keyed LEFT JOIN bad b USING (norm) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN d.text IS NOT NULL THEN sha256(clean) END AS text_sha256
FROM documents d LEFT JOIN done USING (doc_id)
"""

ORACLES: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op5_decontaminate": OP5_SQL, "op8_line_dedup": OP8_SQL}
