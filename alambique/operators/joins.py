"""Equi-joins of a large table that pick their strategy by measured size.

``lookup_join`` broadcasts the smaller side only after measuring it.
``skew_join`` is the way beyond that bound: a shuffle join that spreads the
rows of hot keys over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.storage import Measured, materialize_measured

BROADCAST_BYTES = 128 << 20
BROADCAST_ROWS = 8_000_000

#: Rows of the large side in one task of a shuffle join, and tasks up to which Spark
#: deals them by itself.
TASK_ROWS, TASKS = 500_000, 8

_BUCKETS = 1 << 16
_MAX_PARTS = 1 << 40
_SALT = "__salt"


def fits_broadcast(side: Measured) -> bool:
    return side.rows <= BROADCAST_ROWS and side.size <= BROADCAST_BYTES


def lookup_join(
    large: DataFrame,
    side: DataFrame | Measured,
    keys: str | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join a large table to a side table that is unique on ``keys``.

    A side not measured yet is written to shared storage once, which measures
    it. The large table's column order is kept.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not isinstance(side, Measured):
        side = materialize_measured(side, "side")
    if fits_broadcast(side):
        joined = large.join(F.broadcast(side.df), keys, how)
    else:
        joined = skew_join(large, side.df, keys, how)
    return joined.select(*_output_columns(large, side.df, keys, how))


def skew_join(
    large: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_share: float = 1 / 4096,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Shuffle join in which no key's rows all go to one task.

    One narrow pass counts the large side's rows by hash bucket of the key, at
    most 65,536 groups. A bucket above ``hot_share`` of the table and
    ``hot_rows`` rows is cut into as many parts as it has times ``hot_rows``, by
    a hash of whole rows, and only that bucket's rows of ``side`` are repeated
    for each part. The hash keeps a row in its part when a task is run again.
    The same pass tells how many tasks the join needs for each to sort at most some
    TASK_ROWS rows; dealt by Spark, rows in a task grow with the table.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split the large side of a {how!r} join")
    keys = list(keys)
    total, hot = _counted_buckets(large, keys, hot_share, hot_rows)
    left, right, on = large, side, keys
    if hot:
        parts = F.lit(1)
        for bucket, rows in hot.items():
            parts = F.when(_bucket(keys) == bucket, -(-rows // hot_rows)).otherwise(parts)
        whole = [f"`{f.name}`" for f in large.schema if not _has_map(f.dataType)]
        spread = F.pmod(F.xxhash64(*whole, F.lit(_SALT)), F.lit(_MAX_PARTS))
        left = large.withColumn(_SALT, F.pmod(spread, parts).cast("int"))
        right = side.withColumn(_SALT, F.explode(F.sequence(F.lit(0), parts - 1)))
        on = [*keys, _SALT]
    tasks = -(-total // TASK_ROWS)
    if tasks > TASKS:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right, on, how).drop(_SALT)


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map, which cannot be hashed."""
    return "map<" in kind.simpleString()


def hot_buckets(
    df: DataFrame, keys: Sequence[str], share: float, rows: int
) -> dict[int, int]:
    """Rows of the hash buckets above both bounds; fewer than 1/share of them."""
    return _counted_buckets(df, keys, share, rows)[1]


def _counted_buckets(
    df: DataFrame, keys: Sequence[str], share: float, rows: int
) -> tuple[int, dict[int, int]]:
    """Rows in all, and those of the hot buckets."""
    counts = df.groupBy(_bucket(keys).alias("bucket")).agg(F.count("*").alias("n"))
    large = F.when(F.col("n") > rows, F.struct("bucket", "n"))
    found = counts.agg(F.sum("n").alias("total"), F.collect_list(large).alias("large")).first()
    total = found.total or 0
    return total, {r.bucket: r.n for r in found.large if r.n > total * share}


def anti_join_unknown(
    large: DataFrame, known: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows whose key is not in ``known``; any size on both sides."""
    keys = list(keys)
    distinct = known.select(*keys).dropna().distinct()
    return skew_join(large, distinct, keys, "left_anti").select(*large.columns)


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int")


def _output_columns(
    large: DataFrame, side: DataFrame, keys: Sequence[str], how: str
) -> list[str]:
    if how in ("left_semi", "left_anti"):
        return large.columns
    return [*large.columns, *[c for c in side.columns if c not in keys]]
