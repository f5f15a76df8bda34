"""Helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Texts are handed to Python in pieces of about so many characters, whatever the number of rows in a batch.
PIECE_CHARS = 4_000_000


def pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``PIECE_CHARS`` of text, one row at least."""
    at, size = 0, 0
    for i, length in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        if size and size + (length or 0) > PIECE_CHARS:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += length or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def texts(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; a null text is an empty one."""
    return [t or "" for t in batch.column(text).to_pylist()]


def importable(spark: SparkSession) -> None:
    """Let Python workers started on this machine import the package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def map_texts(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """Apply ``work`` to slices of the Arrow batches of ``df``; each slice is freed before the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield from work(piece)

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def record(types: Sequence[tuple[str, pa.DataType]], columns: Sequence[Iterable]) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, kind)
        for (_, kind), c in zip(types, columns, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in types])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text has the remainder 2 (a null id: learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
