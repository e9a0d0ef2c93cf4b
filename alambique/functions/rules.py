"""Business rules of a sales row: class, price and value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction classes.
RETURN = "DEVOLUCION"
ADJUSTMENT = "AJUSTE_INVENTARIO"
LOST_SALE = "VENTA_PERDIDA"
NO_SALE = "REGISTRO_SIN_VENTA"
NORMAL_SALE = "VENTA_NORMAL"
ANOMALY = "ANOMALO"
CLASSES = (RETURN, ADJUSTMENT, LOST_SALE, NO_SALE, NORMAL_SALE, ANOMALY)

#: Classes whose value is a cost to the business.
COST_CLASSES = (RETURN, ADJUSTMENT, ANOMALY)

#: Flag column of each class that has one.
FLAGS = {
    "Es_Devolucion": RETURN,
    "Es_Ajuste": ADJUSTMENT,
    "Es_Venta_Normal": NORMAL_SALE,
    "Es_Anomalo": ANOMALY,
}



def transaction_class(
    volume: str = "Ventas_Volumen",
    price: str = "Precio",
    out_of_stock: str = "Out_Of_Stock_Flag",
    value: str = "Ventas_Valor",
) -> Column:
    """Class of a row from its values before any repair; first match wins."""
    v, p, o, w = (F.col(c) for c in (volume, price, out_of_stock, value))
    unpaid = F.coalesce(p, F.lit(0.0)) <= 0
    worthless = F.coalesce(w, F.lit(0.0)) == 0
    ordered = (
        (RETURN, (v < 0) & (p > 0)),
        (ADJUSTMENT, (v < 0) & unpaid),
        (LOST_SALE, (v == 0) & (o == 1) & worthless),
        (NO_SALE, (v == 0) & (o == 0) & worthless),
        (NORMAL_SALE, (v > 0) & (p > 0) & (w > 0)),
    )
    verdict = F.lit(ANOMALY)
    for label, condition in reversed(ordered):
        verdict = F.when(condition, label).otherwise(verdict)
    return verdict


def class_flags(kind: Column) -> dict[str, Column]:
    return {flag: kind == label for flag, label in FLAGS.items()}


def valid_sale() -> Column:
    """Rows whose price counts towards the product average."""
    return (
        (F.col("Ventas_Volumen") > 0)
        & (F.col("Precio") > 0)
        & (F.col("Out_Of_Stock_Flag") == 0)
    )


def repaired_price(price: Column, volume: Column, average: Column) -> Column:
    """The product average for a missing price, or one <= 0 on a sold volume."""
    sold_for_nothing = (price <= 0) & (volume > 0)
    return F.when(price.isNull() | sold_for_nothing, average).otherwise(price)


def recomputed_value(kind: Column, price: Column, volume: Column) -> Column:
    """Price times volume; zero where nothing was sold."""
    return F.when(kind.isin(LOST_SALE, NO_SALE), 0.0).otherwise(price * volume)


def value_changed(new: Column, old: Column, tolerance: float = 0.01) -> Column:
    """The value moved by more than the tolerance, relative to the old one."""
    return F.coalesce(F.abs(new - old) > F.abs(old * tolerance), F.lit(False))
