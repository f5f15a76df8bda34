"""The operators over the given tables, as they are registered.

Queries without SQL in ``ORACLES`` are tested against brute force in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.llm.common import documents
from probelake.llm.decontamination import find_leaks
from probelake.llm.html import extract
from probelake.llm.jaccard import connected
from probelake.llm.language import identify
from probelake.llm import naive_bayes, repair
from probelake.llm.oracles import ORACLES as ORACLES
from probelake.llm.packing import pack
from probelake.llm.quality import quality_rules
from probelake.llm import sharding
from probelake.llm.secrets import find_secrets
from probelake.llm.toxicity import score, train
from probelake.llm.transducer import token_counts
from probelake.llm.trie import conversation_trie

TOKENIZER = "byte_bpe_50k.json"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir).select("doc_id"), sharding.shard_names())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    return found.withColumn("base_sha256", F.sha2(F.col("base_spans").cast("binary"), 256)).drop("base_spans")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("longest")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), with_ids=False).drop("ids")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("node", "parent")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return naive_bayes.score(docs, naive_bayes.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_counts": op3_token_counts,
    "op4_html_extraction": op4_html_extraction,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_classifier": op13_quality_classifier,
}
