"""Measured sizes, for deciding whether a join side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What one executor may hold of a broadcast side.
MAX_BROADCAST_BYTES = 256 << 20
# Row header, hash slot and alignment.
ROW_BYTES = 64
# A value of fixed width, or the offset and length of a text.
VALUE_BYTES = 16


def in_memory_bytes(df: DataFrame) -> int:
    """Upper bound of the rows' size in a hash relation, for columns of fixed width and text.

    One scan of the given columns, aggregated before the shuffle; a single
    number comes back.
    """
    row = F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            row = row + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The rows with a broadcast hint if they were measured to fit, else without."""
    return F.broadcast(df) if in_memory_bytes(df) <= max_bytes else df
