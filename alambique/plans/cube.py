"""A maintained cube of costs and sales, from which all reports are read.

The cube has the sums of clean facts by day, class, store, product, and store with
product. Sums can be added, so a load brings only the sums of its own rows, as a
part of the cube's next version; parts are added up when they are read, and merged
from time to time. Reports never go back to the facts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.functions.rules import COST_CLASSES
from alambique.plans import reports
from alambique.schemas import DATE_DIM, PRODUCT_DIM, STORE_DIM
from alambique.sinks.versions import Version, VersionedTable

#: Keys of the cube's sums, and what each row of a set is summed by.
KEYS = ("Fecha_ID", "Tipo_Transaccion", "Tienda_ID", "Producto_ID")
SETS = {
    "dia": ("Fecha_ID",),
    "clase": ("Tipo_Transaccion",),
    "tienda": ("Tienda_ID",),
    "producto": ("Producto_ID",),
    "tienda_producto": ("Tienda_ID", "Producto_ID"),
}

SET = "conjunto"
_MONEY = "decimal(38,4)"
SCHEMA = T.StructType(
    [
        T.StructField("Fecha_ID", T.StringType()),
        T.StructField("Tipo_Transaccion", T.StringType()),
        T.StructField("Tienda_ID", T.IntegerType()),
        T.StructField("Producto_ID", T.IntegerType()),
        T.StructField("transacciones", T.LongType()),
        T.StructField("costo", T.DecimalType(38, 4)),
        T.StructField("ventas", T.DecimalType(38, 4)),
        # Read as a folder of each part, so that a report opens its own set.
        T.StructField(SET, T.StringType()),
    ]
)

_KIND = "cubo"


def cube_rows(fact: DataFrame) -> DataFrame:
    """The sums of clean facts for every set, in one pass over them."""
    sets = [[F.col(k) for k in keys] for keys in SETS.values()]
    cost, sales = reports.cost(), reports.sales()
    sums = fact.select(*KEYS, cost.alias("c"), sales.alias("s")).groupingSets(
        sets, *[F.col(k) for k in KEYS]
    )
    named = F.lit(None).cast("string")
    for name, keys in SETS.items():
        # A bit for each key that the set leaves out, the last key's the lowest.
        out = sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in keys)
        named = F.when(F.col("__set") == out, name).otherwise(named)
    found = sums.agg(
        F.grouping_id().alias("__set"),
        F.count(F.lit(1)).alias("transacciones"),
        F.coalesce(F.sum("c"), F.lit(0)).cast(_MONEY).alias("costo"),
        F.coalesce(F.sum("s"), F.lit(0)).cast(_MONEY).alias("ventas"),
    )
    return found.withColumn(SET, named).select(*SCHEMA.names)


def merged(rows: DataFrame) -> DataFrame:
    """The sums of parts, added up."""
    keys = [SET, *KEYS]
    return rows.groupBy(*keys).agg(
        F.sum("transacciones").alias("transacciones"),
        F.sum("costo").cast(_MONEY).alias("costo"),
        F.sum("ventas").cast(_MONEY).alias("ventas"),
    ).select(*SCHEMA.names)


class Cube:
    """The cube in a folder of its own, and the six reports."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = VersionedTable(spark, root, [SET])

    def add(self, fact: DataFrame) -> Version:
        """Add newly loaded clean facts; they are all of it or nothing."""
        before = self.store.latest()
        part = self.store.write(cube_rows(fact), _KIND)
        return self.store.publish(before, parts=(*before.parts, part))

    def tidy(self) -> None:
        self.store.compact(_KIND, SCHEMA, merged)
        self.store.vacuum()

    def sums(self, name: str, version: Version | None = None) -> DataFrame:
        """The sums of one set in a version, the latest unless one is given."""
        keys = SETS[name]
        found = self.store.read(version or self.store.latest(), _KIND, SCHEMA)
        return found.filter(F.col(SET) == name).groupBy(*keys).agg(
            F.sum("transacciones").alias("transacciones"),
            F.sum("costo").alias("costo"),
            F.sum("ventas").alias("ventas"),
        )

    def _money(self, name: str) -> DataFrame:
        return self.sums(name).drop("transacciones")

    def impact_rate(self) -> DataFrame:
        none = F.lit(0).cast(_MONEY)
        sums = self._money("clase")
        return reports.with_rate(
            sums.agg(
                F.coalesce(F.sum("costo"), none).alias("costo"),
                F.coalesce(F.sum("ventas"), none).alias("ventas"),
            )
        )

    def impact_by_month(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        return reports.by_month(self._money("dia"), dims[DATE_DIM])

    def loss_by_cause(self) -> DataFrame:
        classes = self.sums("clase").drop("ventas")
        return reports.by_cause(classes.filter(F.col("Tipo_Transaccion").isin(*COST_CLASSES)))

    def risk_stores(self, dims: Mapping[str, DataFrame], n: int = 20) -> DataFrame:
        sums = self._money("tienda")
        return reports.ranked(sums, dims[STORE_DIM], "Tienda_ID", reports.STORE_LABELS, n)

    def risk_products(self, dims: Mapping[str, DataFrame], n: int = 20) -> DataFrame:
        sums = self._money("producto")
        return reports.ranked(sums, dims[PRODUCT_DIM], "Producto_ID", reports.PRODUCT_LABELS, n)

    def risk_map(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        return reports.mapped(self._money("tienda_producto"), dims)
