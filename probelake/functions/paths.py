"""Parts of object keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from probelake import fixed


def strip_scheme(path: str) -> str:
    """``file:/a``, ``file:///a`` and ``/a`` all become ``/a``; ``s3://bucket/a`` becomes ``bucket/a``."""
    match = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(//)?(.*)$", path)
    return (match.group(3) if match else path).rstrip("/")


def relative_key(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``; ``''`` if it is not below it."""
    return F.regexp_extract(path, f"(?s)^.*?{re.escape(strip_scheme(root))}/(.*)$", 1)


def key_part(key: Column, index: int, separator: str = "/") -> Column:
    """Part ``index`` (from 0) of the key, or NULL if it has fewer parts."""
    return F.get(F.split(key, re.escape(separator)), F.lit(index))


def top_folder(key: Column) -> Column:
    """First part of the key, or NULL if it is a file name only."""
    return F.when(F.contains(key, F.lit("/")), key_part(key, 0))


def base_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def destination_key(date: Column, key: Column) -> Column:
    return F.concat(date, F.lit("/"), base_name(key))


def to_mib(size_bytes: Column) -> Column:
    return size_bytes / F.lit(fixed.MIB)
