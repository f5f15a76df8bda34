"""Projection, renaming and dropping of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Select (nested) fields under new names, in order."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names the frame does not have are ignored."""
    return df.drop(*names)


def rename_columns(
    df: DataFrame, mappings: Mapping[str, Mapping[str, str]], transformation: str
) -> DataFrame:
    """Rename by the mapping kept for ``transformation``; no mapping or unknown columns change nothing."""
    return df.withColumnsRenamed(dict(mappings.get(transformation, {})))


def add_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))
