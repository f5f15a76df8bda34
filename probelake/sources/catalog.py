"""Schemas and external tables in the Spark catalog."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import SparkSession

from probelake import fixed
from probelake.sources import versions
from probelake.sources.versions import Part

#: Partitions that one statement adds or drops.
AT_ONCE = 200
#: Table property with the number of the pointer that the catalog's partitions are those of.
POINTER = "probelake.pointer"


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def create_table(
    spark: SparkSession, name: str, columns: str, location: str, partition_by: Sequence[str] = ()
) -> None:
    """External Parquet table; ``partition_by`` entries are ``"name type"``."""
    keys = ", ".join(p.split()[0] for p in partition_by)
    fields = ", ".join([columns.strip(), *partition_by])
    partitioning = f" PARTITIONED BY ({keys})" if keys else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{partitioning} LOCATION '{location}'"
    )


def repair(spark: SparkSession, name: str) -> None:
    """Register partitions that jobs wrote as folders, and forget those whose folders are gone."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def point(spark: SparkSession, name: str, path: str) -> None:
    """Let the partitions of a catalog table be those of the table with versions at ``path``.

    What changed since the pointer that the catalog has is added, dropped or moved; nothing is listed. Of each partition
    there must be one version.
    """
    n, parts = versions.current(spark, path) or (0, [])
    if len({part for part, _ in parts}) < len(parts):
        raise ValueError(f"{path} has partitions in several versions; compact it first")
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(POINTER)
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    same = set(versions.pointers(spark, path).get(int(told), [])) if told else set()
    now = dict(parts)
    moved = [p for p in parts if p[0] in known and p not in same]
    for some in _pieces([p for p in parts if p[0] not in known]):
        places = " ".join(f"PARTITION ({_spec(p)}) LOCATION '{_folder(path, p, v)}'" for p, v in some)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    for part, version in moved:
        spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(part)}) SET LOCATION '{_folder(path, part, version)}'")
    for some in _pieces([(p, "") for p in sorted(known - now.keys())]):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(f'PARTITION ({_spec(p)})' for p, _ in some)}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{POINTER}' = '{n}')")
    spark.catalog.refreshTable(name)


def _pieces(parts: Sequence[Part]) -> Iterator[Sequence[Part]]:
    for at in range(0, len(parts), AT_ONCE):
        yield parts[at : at + AT_ONCE]


def _folder(path: str, part: str, version: str) -> str:
    return f"{versions.versions_path(path)}/version={version}/{part}"


def _spec(part: str) -> str:
    pairs = [p.partition("=") for p in part.split("/")]
    return ", ".join(f"{k} = {'NULL' if v == versions.NO_VALUE else repr(v)}" for k, _, v in pairs)


def delivery_table(spark: SparkSession, name: str, location: str) -> None:
    """Serving table over the delivery files; shows the served columns only."""
    create_table(spark, name, fixed.DELIVERY_TABLE_DDL, location, ["bucket_date date"])
    point(spark, name, location)


def quality_log_table(spark: SparkSession, name: str, location: str, run_id: str | None = None) -> None:
    """Table over all quality runs. Of a table that is there only the partition of ``run_id`` is added."""
    there = spark.catalog.tableExists(name)
    create_table(spark, name, fixed.QUALITY_LOG_DDL, location, ["run_id string"])
    if there and run_id:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (run_id = '{run_id}')")
        spark.catalog.refreshTable(name)
    else:
        repair(spark, name)
