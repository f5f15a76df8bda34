"""Scans: raw measurement JSON, Parquet tables, object listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelake.functions.paths import relative_key, top_folder
from probelake.schemas import measurement_schema
from probelake.session import scratch_path
from probelake.sources import versions

#: Lines of JSON as they are or compressed, which Spark tells by the name.
RAW_FILES = "{*.json,*.json.gz}"
#: Bytes of text in a byte of a compressed file, to size jobs by.
GZIP_RATIO = 8
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint"


class UnsupportedFormat(ValueError):
    """The format has no reader."""

    def __init__(self, fmt: str):
        super().__init__(f"no reader for files of type {fmt!r}; known: {sorted(READERS)}")
        self.format = fmt


def read(spark: SparkSession, path: str | Sequence[str], fmt: str, **options) -> DataFrame:
    """Read ``path`` with the reader registered for exactly this format name."""
    if fmt not in READERS:
        raise UnsupportedFormat(fmt)
    return READERS[fmt](spark, path, **options)


def read_measurements(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    glob: str = RAW_FILES,
    folder_column: str | None = None,
) -> DataFrame:
    """One row per line of JSON in all files below ``path`` whose name matches ``glob``.

    A broken line gives a row of NULLs, a value of the wrong type a NULL field. ``folder_column``
    adds the name of the top-level folder below ``path`` (a single root) the row was read from, NULL for
    files in none. A missing or empty folder gives no rows.
    """
    schema = schema or measurement_schema()
    paths = [path] if isinstance(path, str) else list(path)
    if folder_column and len(paths) != 1:
        raise ValueError("folder_column needs a single root")
    reader = (
        spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    )
    try:
        rows = reader.json(paths)
    except AnalysisException as error:
        if not _is_missing_path(error):
            raise
        rows = spark.createDataFrame([], schema)
        return rows.withColumn(folder_column, F.lit(None).cast("string")) if folder_column else rows
    if folder_column:
        uri = F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))")
        rows = rows.select("*", top_folder(relative_key(uri, paths[0])).alias(folder_column))
    return rows


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet with partition discovery; a table with versions (``sources/versions.py``) as its pointer has it."""
    table = table_or_none(spark, path) if isinstance(path, str) else spark.read.parquet(*path)
    return spark.read.parquet(path) if table is None else table


def table_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing has been written there.

    A table that was written without any row has no file to take columns from; with ``schema`` it is an empty
    table, without it is None as well.
    """
    found = versions.current(spark, path)
    try:
        if found:
            return versions.read_parts(spark, path, found[1], schema)
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None if schema is None else spark.read.schema(schema).parquet(path)
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_objects(
    spark: SparkSession, root: str, prefixes: Sequence[str] = ("",), glob: str | None = None
) -> DataFrame:
    """Path and length of every object below ``root`` whose key starts with one of ``prefixes``.

    All prefixes are one listing; nothing but the file status is read. Empty objects are not listed,
    and no match gives no rows. For a store too large to list, pass its inventory table with the same
    columns to the manifest functions instead.

    The scan would get one task per 128 MB of objects although it does not open them, so it runs in a
    session of its own with the number of tasks limited, and the result is staged.
    """
    starts = ",".join(f"{p}*" for p in prefixes)
    pattern = f"{root.rstrip('/')}/" + (f"{{{starts}}}" if len(prefixes) > 1 else starts)
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionNum", str(spark.sparkContext.defaultParallelism))
    reader = listing.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        objects = reader.load(pattern)
    except AnalysisException as error:
        if not _is_missing_path(error):
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    path = scratch_path(spark, "listing")
    objects.select("path", "modificationTime", "length").write.parquet(path)
    return spark.read.schema(LISTING_SCHEMA).parquet(path)


def date_folders(objects: DataFrame, root: str) -> DataFrame:
    """Distinct top-level folders below ``root`` in an object listing."""
    return (
        objects.select(top_folder(relative_key(F.col("path"), root)).alias("source_date"))
        .where(F.col("source_date").isNotNull())
        .distinct()
    )


def _is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


READERS = {"json": read_measurements, "parquet": read_table}
