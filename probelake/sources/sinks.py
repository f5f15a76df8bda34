"""Sinks: partitioned Parquet tables, the quality log, copies of source objects."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.session import COMPRESSION, SHUFFLE_PARTITIONS
from probelake.sources import versions
from probelake.sources.versions import Part

COPY_BLOCK = 8 * 1024 * 1024
#: Of a copy that is not complete.
PART_SUFFIX = ".part"

# Up to this many shuffle partitions Spark keeps the size of every block. Beyond, it keeps averages, and
# adaptive execution does not see, and does not split, a partition that holds most of the rows.
EXACT_SIZES = 2000


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "overwrite",
    overwrite: str = "dynamic",
    rebalance: bool = True,
) -> None:
    """Write a partitioned Parquet table.

    ``overwrite="dynamic"`` replaces only the partitions ``df`` has rows for, ``"static"`` the whole
    table. ``rebalance`` brings rows of a partition together so that every partition gets few files;
    adaptive execution splits partitions above the advisory size, so that a partition with most of the
    rows is still written by many tasks. Without it there is no shuffle and each task writes one file
    per partition value it holds.
    """
    if overwrite not in ("dynamic", "static"):
        raise ValueError(f"overwrite must be dynamic or static, not {overwrite!r}")
    if rebalance:
        pieces = min(int(df.sparkSession.conf.get(SHUFFLE_PARTITIONS)), EXACT_SIZES)
        df = df.hint("rebalance", pieces, *partition_by)
    (
        df.write.partitionBy(*partition_by)
        .mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .option("compression", COMPRESSION)
        .parquet(path)
    )


def write_version(
    df: DataFrame, path: str, version: str, partition_by: Sequence[str], rebalance: bool = True
) -> list[Part]:
    """Write rows as a version of the table at ``path`` (see ``write_partitioned``); no reader sees it yet.

    A version of that name, left by a run that failed, is replaced.
    """
    spark, folder = df.sparkSession, f"{versions.versions_path(path)}/version={version}"
    write_partitioned(df, folder, partition_by, overwrite="static", rebalance=rebalance)
    return [(part, version) for part in versions.partitions_in(spark, path, version)]


def publish(
    df: DataFrame,
    path: str,
    name: str,
    partition_by: Sequence[str],
    replaced: Sequence[str] | None = None,
    rebalance: bool = True,
) -> list[Part]:
    """Write rows and switch the table at ``path`` to them, at once; returns what it consists of then.

    ``replaced`` names the values of the first partition column that this write speaks for: their partitions are
    replaced, or removed where ``df`` has no rows for them, and the others stay. None replaces the whole table. A write
    that fails leaves the table as it was.
    """
    spark = df.sparkSession
    before = versions.current(spark, path)
    n, parts = before if before else (0, [])
    new = write_version(df, path, f"{name}-{n + 1}", partition_by, rebalance)
    gone = {part.split("/")[0] for part, _ in new}
    gone |= {versions.partition_name(partition_by[0], value) for value in replaced or ()}
    stay = [] if replaced is None else [p for p in parts if p[0].split("/")[0] not in gone]
    versions.commit(spark, path, n + 1, [*stay, *new])
    versions.tidy(spark, path)
    return [*stay, *new]


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.partitionBy(*partition_by).mode("append").parquet(path)


def copy_objects(
    objects: DataFrame,
    destination: str,
    tasks: int | None = None,
    storage: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """Copy the objects in ``path`` byte for byte to ``destination``/``dest_key``.

    Returns one row (``dest_key``, ``bytes``) per copy; the copies are made when it is evaluated.
    Files move through executors in blocks, never through the driver. A copy always goes to the same
    place with the same bytes, so that a retried task does no harm. The list is spread by hash of the
    path, so that the files of one folder do not end up in one task. ``storage`` is that of ``LakeConfig``.
    """
    spark = objects.sparkSession
    pairs = objects.select("path", "dest_key").repartition(
        tasks or spark.sparkContext.defaultParallelism, "path"
    )
    target = with_scheme(spark, destination).rstrip("/")
    return pairs.mapInArrow(copier(target, locator(storage)), "dest_key string, bytes bigint")


def with_scheme(spark: SparkSession, path: str) -> str:
    """The path as Spark understands it: without a scheme it is on the default file system."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    # Hadoop's own settings, which PySpark shows nowhere else.
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return f"{default.rstrip('/')}/{path.lstrip('/')}"


def locator(
    storage: Mapping[str, Mapping[str, object]] | None = None,
) -> Callable[[str], tuple[fs.FileSystem, str]]:
    """Function from a URI to its file system and the path there.

    It is sent to executors as it stands, with all it needs inside, so that they need not have this package.
    """
    options = {scheme: dict(values) for scheme, values in (storage or {}).items()}
    kinds = {"s3": "S3FileSystem", "gs": "GcsFileSystem", "abfs": "AzureFileSystem"}

    def locate(uri: str) -> tuple[fs.FileSystem, str]:
        if uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
        uri = re.sub(r"^s3[an]:", "s3:", uri)
        scheme, _, place = uri.partition("://")
        if scheme in options:
            return getattr(fs, kinds[scheme])(**options[scheme]), place
        return fs.FileSystem.from_uri(uri)

    return locate


def copier(
    destination: str, locate: Callable[[str], tuple[fs.FileSystem, str]] | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function that copies batches of (path, dest_key), for executors as ``locator`` is."""
    locate, suffix = locate or locator(), PART_SUFFIX

    def copy_one(source: str, target: str) -> int:
        source_fs, source_path = locate(source)
        target_fs, target_path = locate(target)
        # An object store shows an upload only once it is complete; elsewhere a rename does the same.
        renames = target_fs.type_name in ("local", "hdfs")
        written = f"{target_path}.{uuid.uuid4().hex}{suffix}" if renames else target_path
        if renames:
            target_fs.create_dir(target_path.rsplit("/", 1)[0], recursive=True)
        copied = 0
        with (
            source_fs.open_input_stream(source_path, compression=None) as reader,
            target_fs.open_output_stream(written, compression=None) as writer,
        ):
            while block := reader.read(COPY_BLOCK):
                writer.write(block)
                copied += len(block)
        if renames:
            target_fs.move(written, target_path)
        return copied

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, keys = (column.to_pylist() for column in batch.columns)
            sizes = [copy_one(p, f"{destination}/{k}") for p, k in zip(paths, keys, strict=True)]
            yield pa.RecordBatch.from_pydict({"dest_key": keys, "bytes": sizes})

    return copy
