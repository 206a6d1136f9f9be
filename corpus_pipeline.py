"""The corpus pipeline: documents -> quality rules -> near-duplicates ->
benchmark leaks -> secrets -> mix.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` on all rows that its
predecessor kept; between stages the rows are written as Parquet and read
again, so that a lost executor repeats at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewatch.llm import decontaminate, jaccard, mixing, quality, secret_scan
from gatewatch.llm.tables import staged

# The secret stage is a trained network: SQL cannot express it.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; stop words decide only where they
    cover the language."""
    return quality.keep_good(docs, lang="lang" if "lang" in docs.columns else None)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return jaccard.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; found secrets are replaced in its text."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says, with ``copy_no``."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets_out),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
