"""Broadcast only what has a measured size bound.

A side whose rows and bytes have been measured exactly (the clean step observes
them while it writes the table) is broadcast if both are within the bounds.  All
other joins are left to Spark: it broadcasts by file size or, with AQE, by the
size of a finished shuffle, and else sorts and merges, splitting skewed
partitions.  No probe job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def _value_bytes(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
             T.DateType: 4, T.FloatType: 4}
    return F.lit(fixed.get(type(field.dataType), 16))


def row_bytes(df: DataFrame):
    """Column: byte size of one row (strings by length, fixed types by width)."""
    return sum((_value_bytes(f) for f in df.schema.fields), F.lit(0))


def bounded_broadcast(df: DataFrame, known: tuple[int, int] | None) -> DataFrame:
    """``F.broadcast(df)`` if its measured ``(rows, bytes)`` are within the session
    settings ``shopline.broadcast.maxRows`` / ``maxBytes`` (2,000,000 rows, 64 MiB);
    ``df`` unchanged otherwise, or if nothing was measured."""
    conf = df.sparkSession.conf
    rows = int(conf.get("shopline.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))
    size = int(conf.get("shopline.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    small = known is not None and known[0] <= rows and known[1] <= size
    return F.broadcast(df) if small else df
