"""Object listings by many tasks: a data source whose partitions are folders."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from probelake.session import stage
from probelake.sources.readers import LISTING_SCHEMA, list_objects
from probelake.sources.sinks import locator, with_scheme

#: Schemes that pyarrow lists; others are listed by Spark's file index.
LISTED = ("file", "s3", "s3a", "s3n", "hdfs", "gs", "abfs", "abfss")
#: Folders of one task, once there are more than ``MOST_TASKS`` of them.
MOST_TASKS = 10_000
ROWS = 10_000


def list_prefixes(
    spark: SparkSession,
    root: str,
    prefixes: Sequence[str] = ("",),
    storage: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """The rows of ``list_objects``, found by executors.

    The driver looks up which folders the prefixes begin, level by level as far as the prefixes go, and no file below
    them. Each folder is a task of its own, which lists all that is in it; files beside the folders belong to a task too.
    The result is staged, as a listing is read more than once.
    """
    place = with_scheme(spark, root).rstrip("/")
    if place.partition(":")[0] not in LISTED:
        return list_objects(spark, root, prefixes)
    spark.dataSource.register(_source(place, tuple(prefixes), storage))
    return stage(spark.read.format("object_listing").load(), "listing")


def _source(root: str, prefixes: tuple[str, ...], storage: Mapping[str, Mapping[str, object]] | None) -> type[DataSource]:
    """The data source, made here so that it is sent to executors with all it needs, without this package."""
    locate = locator(storage)
    schema, most, rows = LISTING_SCHEMA, MOST_TASKS, ROWS
    local = root.startswith("file:")

    def hidden(name: str) -> bool:
        return name.startswith(("_", "."))

    class Places(InputPartition):
        """Folders to list with all below them, and files."""

        def __init__(self, folders: list[str], files: list[tuple[str, float, int]]):
            super().__init__(folders)
            self.folders, self.files = folders, files

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            system, top = locate(root)
            folders, files = set(), {}
            for prefix in prefixes:
                at, _, begin = f"{top}/{prefix}".rpartition("/")
                for found in system.get_file_info(fs.FileSelector(at, allow_not_found=True)):
                    if found.base_name.startswith(begin) and not hidden(found.base_name):
                        if found.type == fs.FileType.Directory:
                            folders.add(found.path)
                        elif found.size:
                            files[found.path] = (found.path, found.mtime.timestamp(), found.size)
            each = -(-len(folders) // most) or 1
            ordered = sorted(folders)
            found = [Places(ordered[i : i + each], []) for i in range(0, len(ordered), each)]
            return [*found, Places([], list(files.values()))] if files or not found else found

        def read(self, partition: Places) -> Iterator[pa.RecordBatch]:
            system, top = locate(root)
            scheme = root[: len(root) - len(top)] if root.endswith(top) else re.match(r"^[^:]*://", root)[0]
            start = "file:" if local else scheme

            def told(some: list[tuple[str, float, int]]) -> pa.RecordBatch:
                paths = pa.array([start + path for path, _, _ in some], pa.string())
                times = pa.array([int(t * 1e6) for _, t, _ in some], pa.timestamp("us", "UTC"))
                sizes = pa.array([size for _, _, size in some], pa.int64())
                return pa.RecordBatch.from_arrays([paths, times, sizes], names=["path", "modificationTime", "length"])

            some, waiting = list(partition.files), list(partition.folders)
            while waiting:
                for found in system.get_file_info(fs.FileSelector(waiting.pop())):
                    if hidden(found.base_name):
                        continue
                    if found.type == fs.FileType.Directory:
                        waiting.append(found.path)
                    elif found.size:
                        some.append((found.path, found.mtime.timestamp(), found.size))
                if len(some) >= rows:
                    yield told(some)
                    some = []
            if some:
                yield told(some)

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return "object_listing"

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> Reader:
            return Reader()

    return Listing
