"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The text of a timestamp depends on the time zone and is part of the row key.
UTC = {"spark.sql.session.timeZone": "UTC"}

# Appends and file copies must not run twice at the same time, so speculation stays off.
#: Of tables, also in sessions that were not made here.
COMPRESSION = "zstd"
SETTINGS = {
    **UTC,
    "spark.speculation": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Keeps the sizes of large blocks exact in shuffles of more than 2000 partitions.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    # Page bodies are most of every row; zstd moves and stores a good third less than the defaults.
    "spark.io.compression.codec": "zstd",
    "spark.sql.parquet.compression.codec": COMPRESSION,
    "spark.ui.enabled": "false",
}


def build_session(app: str = "probelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Input bytes per task of a wide shuffle. A gigabyte of raw JSON is some 300 MB shuffled; smaller pieces
# of a very large input would make the number of blocks (scan tasks x shuffle tasks) the bottleneck.
TASK_BYTES = 1024**3
NARROW = 32  # a shuffle of keys or of rows by few partition values needs so many times fewer pieces
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def sized_for(
    spark: SparkSession, scanned_bytes: int, shuffled_bytes: int
) -> AbstractContextManager[None]:
    """Within the block, shuffles have enough partitions and scans few enough tasks for the data.

    Shuffle partitions are only raised; adaptive execution merges those that turn out small. Scan tasks
    grow up to ``TASK_BYTES`` as long as every core still gets several of them.
    """
    partitions = max(int(spark.conf.get(SHUFFLE_PARTITIONS)), math.ceil(shuffled_bytes / TASK_BYTES))
    values = {SHUFFLE_PARTITIONS: str(partitions)}
    per_task = scanned_bytes // (8 * spark.sparkContext.defaultParallelism)
    if per_task > 128 * 1024**2:
        values[SCAN_BYTES] = str(min(per_task, TASK_BYTES))
    return settings(spark, values)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: what the cluster names, or a new local one in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="probelake-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


_SCOPES = threading.local()  # of the thread that plans the jobs; a stream's batches come in one of their own


def _scopes() -> list[str]:
    if not hasattr(_SCOPES, "folders"):
        _SCOPES.folders = []
    return _SCOPES.folders


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Own all intermediate tables that are made within the block: their folder is emptied at its end, also after a
    failure. What is read later is staged with ``result=True`` or read within the block. Blocks may be nested."""
    folder = scratch_path(spark, "scratch")
    _scopes().append(folder)
    try:
        yield folder
    finally:
        _scopes().remove(folder)
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


def scratch_path(spark: SparkSession, name: str, result: bool = False) -> str:
    """A path under the shared folder that nothing else uses, in the innermost ``scratch`` (``result``: the next one)."""
    scopes = _scopes()[:-1] if result else _scopes()
    root = scopes[-1] if scopes else f"{shared_dir(spark)}/probelake"
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and return a scan of it.

    Unlike a cache it survives lost executors, and later jobs read only the columns they need. It belongs to the
    ``scratch`` it is made in; a ``result`` outlives that.
    """
    path = scratch_path(df.sparkSession, name, result)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str, input_bytes: int = 0) -> Iterator[DataFrame]:
    """``stage`` for the time of a block; then the table is overwritten by an empty one.

    The job that writes it is sized for ``input_bytes``.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        with sized_for(spark, input_bytes, input_bytes):
            df.write.option("compression", COMPRESSION).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)
