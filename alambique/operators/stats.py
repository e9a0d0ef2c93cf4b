"""Aggregates the cleaning rules rest on."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.functions.rules import valid_sale


class Bounds(NamedTuple):
    """Mean, sample deviation and the interval of k deviations around the mean."""

    mean: float | None
    stddev: float | None
    low: float | None
    high: float | None


def average_prices(fact: DataFrame) -> DataFrame:
    """Average price per product over valid sales; products without one absent."""
    return (
        fact.filter(valid_sale())
        .groupBy("Producto_ID")
        .agg(F.avg("Precio").alias("Precio_Promedio_Producto"))
    )


def product_profile(fact: DataFrame) -> DataFrame:
    """One row per product of the fact table, NULL average where none is valid."""
    return fact.groupBy("Producto_ID").agg(
        F.avg(F.when(valid_sale(), F.col("Precio"))).alias("Precio_Promedio_Producto"),
        F.count("*").alias("filas"),
        F.count_if(F.col("Distribucion_Ponderada").isNull()).alias("dist_nulas"),
    )


def bounds_frame(df: DataFrame, column: str, k: float) -> DataFrame:
    """One row: mean, stddev and the interval of ``k`` deviations."""
    stats = df.agg(F.mean(column).alias("mean"), F.stddev_samp(column).alias("stddev"))
    return stats.select(
        "mean",
        "stddev",
        (F.col("mean") - k * F.col("stddev")).alias("low"),
        (F.col("mean") + k * F.col("stddev")).alias("high"),
    )


def outlier_bounds(df: DataFrame, column: str, k: float = 3.0) -> Bounds:
    return Bounds(*bounds_frame(df, column, k).first())


def within_bounds(column: Column, bounds: Bounds) -> Column:
    """Rows inside the interval; without a deviation every row is kept."""
    if bounds.stddev is None:
        return F.lit(True)
    return F.coalesce(column.between(bounds.low, bounds.high), F.lit(False))
