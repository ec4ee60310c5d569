"""Joins against a side table, broadcast only when its measured size allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelens.settings import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS


def fits_broadcast(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Measure the side table by one aggregate, which is partial in every task: rows, and bytes of all columns.

    A nested value counts with the length of its JSON text.
    """
    width = F.lit(0)
    for f in side.schema.fields:
        width = width + F.lit(16)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
    seen = side.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def left_lookup(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    small: bool | None = None,
) -> DataFrame:
    """Left join on ``keys``; ``side`` must hold each key once.

    A small side is broadcast, so ``rows`` is not shuffled. Otherwise it is a plain join: adaptive execution splits
    the rows of a hot key by the tasks that wrote them, so nothing is copied but the one side row that key needs.
    ``small`` is the answer of ``fits_broadcast`` where the caller has it; else the side is measured here.
    """
    if fits_broadcast(side) if small is None else small:
        return rows.join(F.broadcast(side), keys, "left")
    return rows.join(side, keys, "left")


def flag_members(rows: DataFrame, words: DataFrame, column: str, flag: str, small: bool | None = None) -> DataFrame:
    """Add a boolean ``flag``: is ``column`` one of ``words``."""
    side = words.select(F.col("word").alias(column), F.lit(True).alias(flag)).distinct()
    joined = left_lookup(rows, side, [column], small)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
