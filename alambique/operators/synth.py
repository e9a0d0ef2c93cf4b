"""Faults planted in given data, and the star's helper tables.

Faults are drawn per row from its id, so each row has the given chance whatever
the table's size and partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.functions import dates
from alambique.operators.joins import lookup_join
from alambique.storage import materialize_all


def inject(
    value: Column, draw: Column, faults: Sequence[tuple[float, Column | None]]
) -> Column:
    """The value, or with each fault's share what that fault makes of it."""
    faulty, bound = None, 0.0
    for share, wrong in faults:
        bound = round(bound + share, 9)
        wrong = F.lit(None) if wrong is None else wrong
        below = draw < bound
        faulty = F.when(below, wrong) if faulty is None else faulty.when(below, wrong)
    return value if faulty is None else faulty.otherwise(value)


def calendar(
    facts: DataFrame, date: str, rows: str = "filas"
) -> DataFrame:
    """One row per day from the first to the last of ``date``.

    It has the date dimension's columns and the day's number of facts. Facts are
    counted per day before they meet the days.
    """
    per_day = facts.groupBy(F.col(date).cast("date").alias("dia")).agg(
        F.count(F.lit(1)).alias(rows)
    )
    ends = per_day.agg(F.min("dia").alias("first"), F.max("dia").alias("last"))
    known = ends.filter("first IS NOT NULL")
    days = known.select(F.explode(F.sequence("first", "last")).alias("dia"))
    return days.join(per_day, "dia", "left").select(
        *[c.alias(name) for name, c in dates.calendar_columns(F.col("dia")).items()],
        F.coalesce(rows, F.lit(0)).alias(rows),
    )


def with_factors(
    facts: DataFrame, dim_tienda: DataFrame, dim_producto: DataFrame
) -> DataFrame:
    """Look up the store's appeal and the product's demand and base price."""
    sides = materialize_all(
        {
            "stores": dim_tienda.select("Tienda_ID", "Atractivo_Factor"),
            "products": dim_producto.select(
                "Producto_ID", "Demanda_Factor", "Precio_Base"
            ),
        }
    )
    return facts.transform(lookup_join, sides["stores"], "Tienda_ID").transform(
        lookup_join, sides["products"], "Producto_ID"
    )


def append_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def shuffle_rows(df: DataFrame, row_id: str, seed: int = 42) -> DataFrame:
    """Rows in a seeded random order over the whole result."""
    return df.orderBy(F.xxhash64(F.col(row_id), F.lit(seed)), row_id)
