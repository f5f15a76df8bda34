"""New raw files to a table without copies, with a bounded memory of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from probelake.plans.config import FOLDER_DATE, GEN_2, Generation
from probelake.plans.trusted import shape
from probelake.session import UTC, settings
from probelake.sources import versions
from probelake.sources.compaction import compacted
from probelake.sources.sinks import write_version
from probelake.streaming.incremental import FILE_BYTES, MANY_VERSIONS, read_new

#: The time of a row in the stream, while it is deduplicated.
TIME = "__time"


def unique(rows: DataFrame, delay: str, key: str = "row_id") -> DataFrame:
    """The first row of every key, as a stream.

    A row's time is when its test, or else its measurement, began, or else its date. A copy that comes while its
    time is within ``delay`` of the latest time seen is dropped. Keys are forgotten ``delay`` after the time of their first
    row, so what is remembered is bounded by the rows of that span, not by the stream. What is older than ``delay`` when it
    comes is dropped, copy or not; a copy with a new time, that comes after its key was forgotten, is a new row. Rows
    without any time have no place in the stream and are left out; rows without a key are copies of each other.
    """
    time = F.coalesce("test_start_time", "measurement_start_time", F.col("bucket_date").cast("timestamp"))
    timed = rows.withColumn(TIME, time).where(F.col(TIME).isNotNull())
    return timed.withWatermark(TIME, delay).dropDuplicatesWithinWatermark([key]).drop(TIME)


def run_unique(
    spark: SparkSession,
    raw: str,
    table: str,
    checkpoint: str,
    delay: str = "7 days",
    generation: Generation = GEN_2,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Add the rows of raw files that came since the last run, without copies (``unique``), to ``table``, then stop.

    The table is shaped like the trusted table before its checks. It has versions (``sources/versions.py``): a batch
    appears at once, and one that is repeated after a failure replaces what it wrote. Returns the query, which has ended,
    for its progress.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        found = versions.pointers(spark, table)
        last = max((n for n in found if n < batch_id), default=None)
        parts = [] if last is None else found[last]
        name = f"batch{batch_id}"
        parts = [p for p in parts if p[1] != name] + write_version(batch, table, name, generation.partition_by)
        parts = compacted(spark, table, f"{name}-compact", parts, FILE_BYTES, MANY_VERSIONS)
        # Batches that come after this one were those of a checkpoint that is lost.
        versions.remove(spark, table, [n for n in found if n > batch_id])
        versions.commit(spark, table, batch_id, parts)
        versions.tidy(spark, table)

    with settings(spark, UTC):
        rows = shape(read_new(spark, raw, files_per_batch), generation).drop(FOLDER_DATE)
        query = unique(rows, delay).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        running = query.outputMode("append").trigger(availableNow=True).start()
        running.awaitTermination()
    return running
