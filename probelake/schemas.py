"""Schemas of the lake, and pruning of a schema down to the fields a job reads."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

from pyspark.sql import types as T

from probelake import fixed


@cache
def measurement_schema() -> T.StructType:
    """Schema of one raw measurement document (needs a running session to parse the DDL)."""
    return T.StructType.fromDDL(fixed.MEASUREMENT_DDL)


def trusted_fields() -> list[str]:
    """Fields of the raw document that the trusted table is made from."""
    return list(fixed.TRUSTED_PROJECTION.values())


def prune(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """Keep only the fields on the dotted ``paths``.

    The JSON source prunes whole top-level columns only; handing it a narrower schema keeps it
    from building nested values that nobody reads.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    missing = set(wanted) - set(schema.fieldNames())
    if missing:
        raise ValueError(f"no such field: {sorted(missing)}")
    return T.StructType(
        [
            T.StructField(f.name, _prune_type(f.dataType, wanted[f.name]), f.nullable)
            for f in schema.fields
            if f.name in wanted
        ]
    )


def _prune_type(dtype: T.DataType, rests: list[str]) -> T.DataType:
    if "" in rests:
        return dtype
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_prune_type(dtype.elementType, rests), dtype.containsNull)
    if isinstance(dtype, T.StructType):
        return prune(dtype, rests)
    raise ValueError(f"{dtype.simpleString()} has no fields {rests}")
