"""Source objects to the raw folder."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.operators.landing import manifest, not_landed, wanted, within_budget
from probelake.plans.config import LakeConfig
from probelake.session import scratch, stage
from probelake.sources.listing import list_prefixes
from probelake.sources.manifest import landed_table, record
from probelake.sources.sinks import copy_objects

# A task copies about so much, but every core gets one.
COPY_TASK_MIB = 256


def choose(
    spark: SparkSession, cfg: LakeConfig, objects: DataFrame | None = None, landed: str | None = None
) -> DataFrame:
    """Source files to land: wanted, not landed before, within the budget per date and country.

    Files that are there already use up no budget; which these are the table of ``landed`` files tells.
    ``objects`` (``path``, ``length``) replaces the listing of the source, for stores that keep an inventory of their
    objects.
    """
    if objects is None:
        objects = list_prefixes(spark, cfg.source, cfg.prefixes, cfg.storage)
    files = manifest(objects, cfg.source, cfg.source_date_index)
    candidates = wanted(files, cfg.test_type, cfg.landing_countries, cfg.min_mib)
    there = spark.table(landed or landed_table(spark, cfg.raw))
    return within_budget(not_landed(candidates, there), cfg.limit_mib, cfg.min_mib)


def ingest(spark: SparkSession, cfg: LakeConfig, objects: DataFrame | None = None) -> DataFrame:
    """Copy the chosen files; returns the copies made (``dest_key``, ``bytes``), which are then recorded as landed."""
    with scratch(spark):
        table = landed_table(spark, cfg.raw)
        chosen = stage(choose(spark, cfg, objects, table), "chosen")
        copies = copy_objects(chosen, cfg.raw, copy_tasks(chosen), cfg.storage)
        landed = stage(copies, "landed", result=True)
        record(spark, table, landed)
    return landed


def copy_tasks(chosen: DataFrame) -> int:
    """Tasks to copy the files with, by their number and bytes, one for each core at least."""
    total = chosen.agg(F.count("*").alias("files"), F.sum("size_mb").alias("mib")).first()
    least = chosen.sparkSession.sparkContext.defaultParallelism
    return max(1, min(total.files, max(least, math.ceil((total.mib or 0) / COPY_TASK_MIB))))
