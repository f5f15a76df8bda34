"""Stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

All columns of ``docs`` come along, whatever their names, but for the last stage. Null texts count as empty ones; empty
texts are neither toxic nor copies nor contaminated nor secret and stay to the end. Rows with null or equal ids are
documents like others. An empty table passes as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from probelake.llm.decontamination import without_leaks
from probelake.llm.jaccard import without_copies
from probelake.llm.packing import pack
from probelake.llm.queries import TOKENIZER
from probelake.llm.secrets import redact
from probelake.llm.toxicity import train, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected as toxic; without toxic labels none is."""
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id; of rows equal in id and text one stays."""
    return without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; with an empty benchmark all."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with their token ids; a document without text is its end mark alone."""
    return pack(docs, public_tokenizers.path(TOKENIZER))
