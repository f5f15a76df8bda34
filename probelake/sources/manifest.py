"""What has been landed, as a table bucketed by destination key.

A run reads from it what is there already, instead of listing the raw folder, and adds what it copied when all its copies
are complete: a copy that failed half way is not in it and is made again, to the same place. As the table lies in
buckets of the key, the anti join of new files with it moves the new files only.

The files are Parquet below ``<raw>/_landed``, a name that scans of raw data pass over. Their place tells the number of
buckets; the catalog entry is made from it, so that a session without a lasting catalog finds them again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.functions.paths import relative_key
from probelake.sources.readers import list_objects
from probelake.sources.sinks import PART_SUFFIX

BUCKETS = 64
COLUMNS = "dest_key STRING, bytes BIGINT"


def landed_table(spark: SparkSession, raw: str, buckets: int = BUCKETS) -> str:
    """Name of the table of the files landed below ``raw``.

    A folder that was filled without one, or before there was one, is listed once to begin it.
    """
    place = f"{raw.rstrip('/')}/_landed/buckets-{buckets}"
    name = f"default.landed_{hashlib.md5(place.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
        f"CLUSTERED BY (dest_key) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.refreshTable(name)
    if spark.table(name).isEmpty():
        there = list_objects(spark, raw).select(relative_key(F.col("path"), raw).alias("dest_key"), F.col("length").alias("bytes"))
        there = there.where(~F.col("dest_key").startswith("_") & ~F.col("dest_key").endswith(PART_SUFFIX))
        if not there.isEmpty():
            record(spark, name, there, buckets)
    return name


def record(spark: SparkSession, name: str, copies: DataFrame, buckets: int = BUCKETS) -> None:
    """Add complete copies (``dest_key``, ``bytes``): a file for each bucket, by as many tasks."""
    rows = copies.select("dest_key", F.col("bytes").cast("bigint").alias("bytes"))
    rows.repartition(buckets, "dest_key").write.insertInto(name)
    spark.catalog.refreshTable(name)


def landed_objects(spark: SparkSession, raw: str) -> DataFrame:
    """The landed files as a listing (``path``, ``length``)."""
    rows = spark.table(landed_table(spark, raw))
    return rows.select(F.concat(F.lit(raw.rstrip("/") + "/"), "dest_key").alias("path"), F.col("bytes").alias("length"))
