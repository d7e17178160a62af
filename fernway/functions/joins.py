"""Joins of a large table to a table that is usually, but not surely, small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure whether ``df`` is within a row and a byte limit.

    Rows are counted and sized where they are; one row of totals reaches the driver.
    """
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
        else F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.lit(16)
        for f in df.schema.fields
    ]
    width = reduce(lambda a, b: a + b, widths)
    rows, size = df.select(width.alias("w")).agg(F.count("*"), F.sum("w")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join to a dimension whose few keys may each be held by very many rows.

    A side measured to be within the limits is broadcast, so hot keys of ``big`` stay where
    they are. A larger side takes Spark's shuffled join, where adaptive execution splits
    the partitions that a hot key fills (``session.SQL_SETTINGS`` turns that on). Measuring
    reads ``small`` once, so it should be cheap to compute.
    """
    if fits_broadcast(small):
        small = F.broadcast(small)
    return big.join(small, on, how)
