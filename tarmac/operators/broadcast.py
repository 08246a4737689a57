"""Broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bounds for dimension tables: (key, code, name) rows are about 100 bytes each.
DIM_BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text and binary as they are, 16 for a decimal, 8 for anything else."""
    total = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        else:
            total = total + F.lit(16 if isinstance(f.dataType, T.DecimalType) else 8)
    return total


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of values.

    Counting stops after ``max_rows + 1`` rows, so the check costs at most one
    bounded scan; meant for materialised (table) inputs.
    """
    some = df.limit(max_rows + 1)
    n, size = some.agg(F.count(F.lit(1)), F.sum(row_bytes(some))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it ``fits``.

    Larger inputs are returned unchanged and join by shuffle (sort-merge, with
    AQE splitting skewed partitions).
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
