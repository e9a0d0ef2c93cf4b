"""Duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns in order, NULLs last.

    A minimum of structs is combined before the shuffle, so a key with any
    number of copies sends one row per task. Structs are combined in sorted
    order: each task sorts its rows by key first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    parts = []
    for c in rest:
        parts += [F.col(c).isNull().alias(f"{c}__null"), F.col(c)]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col("kept")[c].alias(c) for c in df.columns]
    )


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count("*").alias("filas")).filter("filas > 1")
