"""Partitioned Parquet tables that change all at once.

Rows lie in version folders, ``<path>/_table/versions/version=<v>/<partition>/``, which are written once. What the table
consists of is a list of (partition, version): the pointer, a single file below ``<path>/_table/pointers/n=<n>``. The
highest ``n`` holds. A write that fails before its pointer is there changes nothing, readers go on with the table as it
was, and the pointer switches all partitions together. A partition may have several versions, whose rows add up.

The folder names keep both from readers that take ``path`` as a plain Parquet table, which would mix versions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
POINTER = "part string, version string"
#: Pointers that stay, so that a reader who began before the last switch can finish.
KEPT = 2

#: (partition such as ``a=1/b=2``, or nothing for a table without; version)
Part = tuple[str, str]


def partition_name(column: str, value: object) -> str:
    return f"{column}={NO_VALUE if value is None else value}"


def versions_path(path: str) -> str:
    return f"{path.rstrip('/')}/_table/versions"


def _pointers_path(path: str) -> str:
    return f"{path.rstrip('/')}/_table/pointers"


def pointers(spark: SparkSession, path: str) -> dict[int, list[Part]]:
    """The pointers that are there, by number; each lists a partition once per version."""
    try:
        reader = spark.read.schema(f"{POINTER}, n int").option("pathGlobFilter", "*.json")
        rows = reader.json(_pointers_path(path)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[int, list[Part]] = {}
    for row in rows:
        parts = found.setdefault(row.n, [])
        if row.version is not None:  # the row that every pointer has, also that of an empty table
            parts.append((row.part or "", row.version))
    return found


def current(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, list[Part]] | None:
    """Number and parts of the table (below ``before``, if given); None if it was never committed."""
    found = {n: parts for n, parts in pointers(spark, path).items() if before is None or n < before}
    return max(found.items()) if found else None


def commit(spark: SparkSession, path: str, n: int, parts: Iterable[Part]) -> None:
    """Make ``parts`` the table. The pointer is one file, which Spark moves to its place when it is complete."""
    rows = [(None, None), *((part or None, version) for part, version in sorted(set(parts)))]
    columns = [pa.array(c, pa.string()) for c in zip(*rows)]
    pointer = spark.createDataFrame(pa.table(columns, names=["part", "version"]))
    pointer.coalesce(1).write.mode("overwrite").json(f"{_pointers_path(path)}/n={n}")


def partitions_in(spark: SparkSession, path: str, version: str) -> list[str]:
    """The partitions that a version has files of; the files are listed, not read."""
    folder = f"{versions_path(path)}/version={version}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.option("pathGlobFilter", "*.parquet").load(folder).inputFiles()
    mark = f"/version={version}/"
    return sorted({unquote(f).rpartition(mark)[2].rpartition("/")[0] for f in files})


def read_parts(
    spark: SparkSession, path: str, parts: Sequence[Part], schema: T.StructType | None = None
) -> DataFrame | None:
    """Rows of some parts of a table. None: there are none, and no schema to tell the columns of an empty table."""
    if not parts:
        return None if schema is None else spark.createDataFrame([], schema)
    root = versions_path(path)
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
    folders = [f"{root}/version={version}/{part}".rstrip("/") for part, version in parts]
    return reader.parquet(*folders).drop("version")


def empty_folder(spark: SparkSession, path: str) -> None:
    """Remove all that is below a folder, by writing a table without rows there."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def remove(spark: SparkSession, path: str, numbers: Iterable[int], gone: Iterable[str] = ()) -> None:
    """Remove pointers, and versions that no other pointer has."""
    for version in gone:
        empty_folder(spark, f"{versions_path(path)}/version={version}")
    for n in numbers:
        empty_folder(spark, f"{_pointers_path(path)}/n={n}")


def outdated(found: dict[int, list[Part]], kept: int = KEPT) -> tuple[list[int], list[str]]:
    """All pointers but the last, and the versions that only these have."""
    stay = sorted(found)[-kept:]
    old = [n for n in found if n not in stay]
    needed = {version for n in stay for _, version in found[n]}
    return sorted(old), sorted({v for n in old for _, v in found[n]} - needed)


def tidy(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Remove what no reader needs any more."""
    remove(spark, path, *outdated(pointers(spark, path), kept))
