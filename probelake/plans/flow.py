"""The stages one after the other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from probelake.plans.config import LakeConfig
from probelake.plans.delivery import build_delivery
from probelake.plans.ingest import ingest
from probelake.plans.trusted import build_trusted, new_run_id
from probelake.sources.catalog import create_schema, delivery_table, quality_log_table
from probelake.sources.manifest import landed_objects


@dataclass(frozen=True)
class RunResult:
    landed: DataFrame
    quality: DataFrame | None  # None: no raw data, nothing done


def run(
    spark: SparkSession, cfg: LakeConfig, run_id: str | None = None, objects: DataFrame | None = None
) -> RunResult:
    """Ingest, trusted table, catalog, delivery table.

    ``objects`` (``path``, ``length``) replaces the listing of the source. The raw folder is not listed either: what is in
    it the table of landed files tells.
    """
    landed = ingest(spark, cfg, objects)
    run_id = run_id or new_run_id()
    checked = build_trusted(spark, cfg, run_id, landed_objects(spark, cfg.raw))
    if checked is None:
        return RunResult(landed, None)
    if cfg.schema:
        create_schema(spark, cfg.schema, cfg.schema_location)
        quality_log_table(spark, f"{cfg.schema}.quality_log", cfg.logs, run_id)
    if build_delivery(spark, cfg) and cfg.schema:
        delivery_table(spark, f"{cfg.schema}.delivery", cfg.delivery)
    return RunResult(landed, checked)
