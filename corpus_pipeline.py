"""The training-data pipeline: quality rules, line dedup, near-duplicate join, decontamination, BPE.

Every stage takes the table its predecessor kept and returns a table with the columns of ``documents``,
but for the last, which returns ids and digests per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sublens.llm import bpe, decontaminate, jaccard, line_dedup, quality
from sublens.llm.scratch import documents, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.stage(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.stage(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.stage(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.stage(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("BPE encoding and decoding", encode),
]

# Robust estimates and tokenization have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
