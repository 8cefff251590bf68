"""Joins with a side whose size is measured first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table is sent to all tasks only if its values take at most this many bytes.
BROADCAST_BYTES = 32 << 20


def _bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):  # of numbers, or of structs of a few
        return F.coalesce(F.size(field.name), F.lit(0)) * 32 + 16
    return F.lit(8)


def if_small(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``table``, a stored table, marked for broadcast if its values are measured to be small.
    A larger one is joined by shuffling, with hot keys split at run time."""
    each = sum((_bytes(f) for f in table.schema), F.lit(8))
    return F.broadcast(table) if (table.agg(F.sum(each.cast("long"))).first()[0] or 0) <= limit else table
