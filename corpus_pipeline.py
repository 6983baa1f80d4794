"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverair.llm import stages
from silverair.session import configure, scratch_path

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("suffix_array_dedup", stages.suffix_array_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("sentencepiece", stages.sentencepiece),
]

# SQL cannot express fitted models, fingerprints and token ids. tests/llm holds
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``. Each result is written to the shared folder and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
