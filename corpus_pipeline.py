"""Documents through toxicity, near-duplicate, benchmark, secret and packing stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from probelake.llm import stages
from probelake.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.toxicity),
    ("near duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secrets", stages.secrets),
    ("packing", stages.packing),
]

#: Trained models and tokenizers are not SQL; tests/llm compares the chain with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage works on a table that holds what the stage before has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *filters, (_, last) = STAGES
    for name, function in filters:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return last(spark, docs, sf_dir)
