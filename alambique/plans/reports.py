"""Loss and risk measures over the clean star schema.

Cost is the absolute value of returns, adjustments and anomalies; sales are the
value of normal sales. Money is summed as decimals, so the order of rows and
partitions cannot change a result. Facts are summed per key before they meet a
dimension, so the join works on totals and not on rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alambique.functions.rules import (
    ADJUSTMENT,
    ANOMALY,
    COST_CLASSES,
    NORMAL_SALE,
    RETURN,
)
from alambique.operators.joins import lookup_join
from alambique.schemas import DATE_DIM, FACT, PRODUCT_DIM, STORE_DIM
from alambique.storage import materialize_all

_MONEY = "decimal(20,4)"

#: What each cost class points at.
CAUSES = {RETURN: "Calidad", ADJUSTMENT: "Proceso", ANOMALY: "Dato"}

Star = Mapping[str, DataFrame]


def cost() -> Column:
    value = F.abs(F.col("Ventas_Valor")).cast(_MONEY)
    return F.when(F.col("Tipo_Transaccion").isin(*COST_CLASSES), value)


def sales() -> Column:
    value = F.col("Ventas_Valor").cast(_MONEY)
    return F.when(F.col("Tipo_Transaccion") == NORMAL_SALE, value)


def totals(fact: DataFrame, *by: str) -> DataFrame:
    """Cost and sales, per key if given."""
    return fact.groupBy(*by).agg(
        F.coalesce(F.sum(cost()), F.lit(0).cast(_MONEY)).alias("costo"),
        F.coalesce(F.sum(sales()), F.lit(0).cast(_MONEY)).alias("ventas"),
    )


def _again(sums: DataFrame, *by: str) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.sum("costo").alias("costo"), F.sum("ventas").alias("ventas")
    )


def with_rate(sums: DataFrame) -> DataFrame:
    """Money as doubles, with the cost over sales; NULL without sales."""
    cost, sales = F.col("costo").cast("double"), F.col("ventas").cast("double")
    rate = F.try_divide(cost, sales).alias("tasa_impacto")
    others = [c for c in sums.columns if c not in ("costo", "ventas")]
    return sums.select(*others, cost.alias("costo"), sales.alias("ventas"), rate)


def impact_rate(star: Star) -> DataFrame:
    """Operational impact rate of the whole period."""
    return with_rate(totals(star[FACT]))


def impact_by_month(star: Star) -> DataFrame:
    return by_month(totals(star[FACT], "Fecha_ID"), star[DATE_DIM])


def by_month(days: DataFrame, dates: DataFrame) -> DataFrame:
    """Rate by month, from the sums of each day."""
    months = dates.select("Fecha_ID", "Anio", "Mes")
    dated = lookup_join(days, months, "Fecha_ID", "inner")
    return with_rate(_again(dated, "Anio", "Mes")).orderBy("Anio", "Mes")


def loss_by_cause(star: Star) -> DataFrame:
    """Cost per cost class with its cause and its share of all cost."""
    classes = star[FACT].filter(F.col("Tipo_Transaccion").isin(*COST_CLASSES))
    per_class = classes.groupBy("Tipo_Transaccion").agg(
        F.count("*").alias("transacciones"),
        F.coalesce(F.sum(cost()), F.lit(0).cast(_MONEY)).alias("costo"),
    )
    return by_cause(per_class)


def by_cause(per_class: DataFrame) -> DataFrame:
    """Causes and shares, from the rows and the cost of each cost class."""
    cost = F.col("costo").cast("double")
    # At most as many rows as there are cost classes meet in the window.
    whole = F.sum("costo").over(Window.partitionBy()).cast("double")
    cause = F.lit(None).cast("string")
    for kind, name in CAUSES.items():
        cause = F.when(F.col("Tipo_Transaccion") == kind, name).otherwise(cause)
    return per_class.select(
        "Tipo_Transaccion",
        cause.alias("causa"),
        "transacciones",
        cost.alias("costo"),
        F.try_divide(cost, whole).alias("participacion"),
    )


def worst(star: Star, dim: str, key: str, attributes: list[str], n: int) -> DataFrame:
    """The ``n`` members of a dimension with the highest cost, smallest key first."""
    return ranked(totals(star[FACT], key), star[dim], key, attributes, n)


def ranked(
    sums: DataFrame, members: DataFrame, key: str, attributes: list[str], n: int
) -> DataFrame:
    """The ``n`` keys with the highest cost; only those meet their dimension."""
    order = [F.desc("costo"), F.col(key)]
    top = sums.orderBy(*order).limit(n)
    top = top.withColumn("posicion", F.row_number().over(Window.orderBy(*order)))
    named = members.select(key, *attributes).join(F.broadcast(top), key)
    return with_rate(named).orderBy("posicion")


#: Labels that the worst stores and products are shown with.
STORE_LABELS = ["Region", "Formato_Tienda"]
PRODUCT_LABELS = ["Marca", "Segmento"]


def risk_stores(star: Star, n: int = 20) -> DataFrame:
    return worst(star, STORE_DIM, "Tienda_ID", STORE_LABELS, n)


def risk_products(star: Star, n: int = 20) -> DataFrame:
    return worst(star, PRODUCT_DIM, "Producto_ID", PRODUCT_LABELS, n)


def risk_map(star: Star) -> DataFrame:
    """Cost per region and segment in quartiles, 1 the highest."""
    return mapped(totals(star[FACT], "Tienda_ID", "Producto_ID"), star)


def mapped(pairs: DataFrame, star: Star) -> DataFrame:
    """Quartiles of regions and segments, from the sums of stores with products.

    The ranking sees one row per pair of labels, however many facts there are.
    """
    regions = star[STORE_DIM].select("Tienda_ID", "Region")
    segments = star[PRODUCT_DIM].select("Producto_ID", "Segmento")
    sides = materialize_all({"regions": regions, "segments": segments})
    placed = lookup_join(pairs, sides["regions"], "Tienda_ID", "inner")
    placed = lookup_join(placed, sides["segments"], "Producto_ID", "inner")
    sums = _again(placed, "Region", "Segmento")
    order = Window.orderBy(
        F.desc("costo"),
        F.col("Region").asc_nulls_last(),
        F.col("Segmento").asc_nulls_last(),
    )
    return with_rate(sums.withColumn("cuartil", F.ntile(4).over(order)))
