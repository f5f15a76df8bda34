"""Access to nested arrays and structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_element(array: Column) -> Column:
    """Element 0, or NULL for an empty or NULL array."""
    return F.get(array, F.lit(0))


def first_body(requests: Column) -> Column:
    """Response body of the first request, ``''`` if any level is missing.

    Only this path of the nested column is referenced, so the scan reads nothing else of it.
    """
    return F.coalesce(first_element(requests)["response"]["body"], F.lit(""))


def field_of_each(array: Column, field: str, inner: bool = False) -> Column:
    """The named field of every struct in an array, or, with ``inner``, in an array of arrays.

    On a plain array this is a field access, to which the scan can narrow itself.
    """
    if inner:
        return F.transform(array, lambda x: x.getField(field))
    return array.getField(field)


def drop_nulls(array: Column) -> Column:
    """The array without its NULL elements (NULLs inside inner arrays stay)."""
    return F.filter(array, lambda x: x.isNotNull())
