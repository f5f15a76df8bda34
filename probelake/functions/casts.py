"""Casts that give NULL for malformed text, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date(text: Column) -> Column:
    return text.try_cast("date")


def to_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def row_key(*parts: Column) -> Column:
    """md5 of the parts' text put together without a separator; NULL if any part is NULL."""
    return F.md5(F.concat(*[p.cast("string") for p in parts]))
