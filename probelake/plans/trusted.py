"""Raw measurements to the trusted table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from probelake import fixed
from probelake.functions.casts import row_key, to_date, to_timestamp
from probelake.functions.nested import first_element
from probelake.functions.text import ip_flag, url_flag
from probelake.operators import quality
from probelake.operators.columns import derive, project
from probelake.operators.dedup import deduplicate, deduplicate_stored
from probelake.plans.config import FOLDER_DATE, GEN_2, Generation, LakeConfig
from probelake.schemas import measurement_schema, prune, trusted_fields
from probelake.session import NARROW, UTC, scratch, settings, sized_for, stage
from probelake.sources.readers import GZIP_RATIO, RAW_FILES, date_folders, list_objects, read
from probelake.sources.sinks import publish

# Copies of a measurement differ, if at all, in when and by which report they were sent.
SURVIVOR_ORDER = ("test_start_time", "report_id")


def shape(raw: DataFrame, generation: Generation = GEN_2) -> DataFrame:
    """Project, cast and key raw measurements; other columns of ``raw`` pass through in front."""
    extra = [FOLDER_DATE] if FOLDER_DATE in raw.columns else []
    rows = project(raw, {**{c: c for c in extra}, **fixed.TRUSTED_PROJECTION})
    if generation.first_query_only:
        rows = derive(rows, {"queries": first_element(F.col("queries"))})
    rows = derive(
        rows,
        {
            "bucket_date": to_date(F.col("bucket_date")),
            "measurement_start_time": to_timestamp(F.col("measurement_start_time")),
            "test_start_time": to_timestamp(F.col("test_start_time")),
        },
    )
    columns = {"row_id": row_key(F.col("id"), F.col("measurement_start_time"), F.col("input"))}
    if generation.validity_flags:
        columns["is_ip_valid"] = ip_flag(F.col("probe_ip"))
        columns["is_url_valid"] = url_flag(F.col("input"))
    return derive(rows, columns)


def transform(
    raw: DataFrame, generation: Generation = GEN_2, null_keys: str = "collapse", keep: str = "first"
) -> DataFrame:
    """Shaped measurements, one row per ``row_id`` (within each landing folder, if ``raw`` names it)."""
    rows = shape(raw, generation)
    within = [FOLDER_DATE] if FOLDER_DATE in rows.columns else []
    return deduplicate(rows, "row_id", keep, SURVIVOR_ORDER, within, null_keys)


def trusted_schema(spark: SparkSession, generation: Generation = GEN_2) -> StructType:
    """Columns of the trusted table."""
    empty = spark.createDataFrame([], prune(measurement_schema(), trusted_fields()))
    return shape(empty, generation).schema


def read_raw(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """Scan of the raw folder that parses only what the trusted table needs.

    Where folders are units, files outside of any folder are left out.
    """
    schema = prune(measurement_schema(), trusted_fields())
    if not cfg.generation.per_folder:
        return read(spark, cfg.raw, "json", schema=schema)
    rows = read(spark, cfg.raw, "json", schema=schema, folder_column=FOLDER_DATE)
    return rows.where(F.col(FOLDER_DATE).isNotNull())


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%f")


def checked_run_id(run_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run_id is used as a folder name: {run_id!r}")
    return run_id


def log_quality(
    rows: DataFrame,
    generation: Generation,
    path: str,
    run_id: str,
    by: list[str],
    groups: DataFrame | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """Check ``rows``, add the report to the log and return this run's part of the log.

    ``groups`` and ``distinct`` are those of ``quality.measure``.
    """
    checked_run_id(run_id)
    checked = quality.report(rows, generation.constraints, by, groups=groups, distinct=distinct)
    return log_report(checked, path, run_id, by)


def log_report(checked: DataFrame, path: str, run_id: str, by: list[str]) -> DataFrame:
    """Add a report to the log, one file in a folder of the run, and return it as it is there.

    A run that is repeated under its id replaces its own report, so decisions never mix two reports. A report without
    rows is logged as one.
    """
    if by:
        checked = checked.withColumnRenamed(by[0], "bucket_date")
    place = f"{path.rstrip('/')}/run_id={checked_run_id(run_id)}"
    checked.coalesce(1).write.mode("overwrite").parquet(place)
    return checked.sparkSession.read.schema(checked.schema).parquet(place)


def build_trusted(
    spark: SparkSession, cfg: LakeConfig, run_id: str | None = None, objects: DataFrame | None = None
) -> DataFrame | None:
    """Write the trusted table from all raw files; returns the quality report of the run.

    The shaped rows are written to a staging table once, without a shuffle. The keys are then counted and the
    checks made from a few narrow columns of it, and the rows that stay go from it to the trusted table: the raw
    JSON is parsed once, and a wide row is shuffled once, to the date it is stored under, unless it has copies.
    Returns None if there is nothing to do: no raw file with anything in it. A landing folder whose files give no rows is
    reported with the size 0. Readers see the table as it was until all of it is there. ``objects`` (``path``,
    ``length``) replaces the listing of the raw folder, which the folders and the sizes of the jobs are taken from.
    """
    with scratch(spark):
        return _build_trusted(spark, cfg, run_id or new_run_id(), objects)


def _build_trusted(
    spark: SparkSession, cfg: LakeConfig, run_id: str, objects: DataFrame | None
) -> DataFrame | None:
    generation = cfg.generation
    if objects is None:
        objects = list_objects(spark, cfg.raw, glob=RAW_FILES)
    text = F.when(F.col("path").endswith(".gz"), F.col("length") * GZIP_RATIO).otherwise(F.col("length"))
    stored_bytes, raw_bytes = objects.agg(F.sum("length"), F.sum(text)).first()
    if not raw_bytes:
        return None
    by = [FOLDER_DATE] if generation.per_folder else []
    with settings(spark, UTC):
        with sized_for(spark, stored_bytes, raw_bytes):
            shaped = stage(shape(read_raw(spark, cfg), generation), "trusted")
        with sized_for(spark, stored_bytes, raw_bytes // NARROW):
            return _from_shaped(spark, cfg, run_id, objects, shaped, by)


def _from_shaped(
    spark: SparkSession, cfg: LakeConfig, run_id: str, objects: DataFrame, shaped: DataFrame, by: list[str]
) -> DataFrame:
    generation = cfg.generation
    rows = deduplicate_stored(shaped, "row_id", "first", SURVIVOR_ORDER, by, cfg.null_keys)
    folders = date_folders(objects, cfg.raw).withColumnRenamed("source_date", FOLDER_DATE) if by else None
    checked = log_quality(rows, generation, cfg.logs, run_id, by, folders, ["row_id"])
    decided = checked.withColumnRenamed("bucket_date", FOLDER_DATE) if by else checked
    clean = quality.remediate(
        rows, decided, generation.constraints, generation.droppable, by, cfg.substring_match
    )
    # The dates of one run are few. Those whose rows all go lose their partitions.
    dynamic = generation.overwrite == "dynamic"
    dates = [r[0] for r in shaped.select("bucket_date").distinct().collect()] if dynamic else None
    publish(clean.drop(FOLDER_DATE), cfg.trusted, run_id, generation.partition_by, dates)
    return checked
