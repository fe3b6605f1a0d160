"""A corpus pipeline over `documents`: toxicity, line dedup, near duplicates, decontamination, BPE.

Every stage works on all rows that its predecessor kept. All but the last return the columns of documents (n_chars follows the
text where lines go); the last returns each document's token ids. Filtering stages know a row by its id and its text: a row with a
null or shared id is judged by its own text, and rows alike in both are judged alike (of near copies, one of them stays).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from tessera.llm.common import Scratch, temporary
from tessera.llm.queries import BYTE_BPE, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_lines(docs, length_col="n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_stage(docs, vocabulary(BYTE_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: Learned toxicity scores, MinHash and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with temporary():
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.only(name)
    return docs
