"""What a fit needs to know of the facts, kept month by month.

Each month has a state: count, mean and squared deviations of the volumes, count and
sum of each product's valid prices, and a quantile sketch of the prices. States
merge, so the fit of all months needs only them; a month that changes is measured
again by itself, and its newest state counts. Nothing else of the facts is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.functions.rules import valid_sale
from alambique.operators.joins import lookup_join
from alambique.operators.stats import Bounds
from alambique.plans.loading import month_of
from alambique.sinks.versions import Version, VersionedTable

#: Size of a quantile sketch, and how far its ranks may be off.
SKETCH_K, RANK_ERROR = 1024, 0.005

MONTH, LOAD = "mes", "carga"
_VOLUMES, _PRICES = "volumenes", "precios"

_VOLUME_SCHEMA = T.StructType(
    [
        T.StructField(MONTH, T.StringType()),
        T.StructField(LOAD, T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("media", T.DoubleType()),
        # Sum of the squared distances from the mean.
        T.StructField("m2", T.DoubleType()),
        T.StructField("boceto", T.BinaryType()),
    ]
)
_PRICE_SCHEMA = T.StructType(
    [
        T.StructField(MONTH, T.StringType()),
        T.StructField(LOAD, T.LongType()),
        T.StructField("Producto_ID", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("suma", T.DoubleType()),
    ]
)


def volume_states(fact: DataFrame, column: str = "Ventas_Volumen") -> DataFrame:
    """The state of each month's volumes, and the sketch of its positive prices."""
    x = F.col(column).cast("double")
    n = F.count(x)
    return fact.groupBy(month_of("Fecha_ID").alias(MONTH)).agg(
        n.alias("n"),
        F.coalesce(F.avg(x), F.lit(0.0)).alias("media"),
        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("m2"),
        F.kll_sketch_agg_double(
            F.when(F.col("Precio") > 0, F.col("Precio")), F.lit(SKETCH_K)
        ).alias("boceto"),
    )


def price_states(fact: DataFrame) -> DataFrame:
    """Count and sum of the valid prices of each month's products."""
    return (
        fact.filter(valid_sale() & F.col("Precio").isNotNull())
        .groupBy(month_of("Fecha_ID").alias(MONTH), "Producto_ID")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("Precio").alias("suma"))
    )


def merged_moments(states: DataFrame) -> DataFrame:
    """One row with ``n, media, m2`` of all states.

    The squared distances from the common mean are those from each mean, plus for
    each state its rows times the squared distance of its mean.
    """
    # The window sees one row for each month.
    whole = Window.partitionBy()
    total = F.sum("n").over(whole)
    mean = F.try_divide(F.sum(F.col("n") * F.col("media")).over(whole), total)
    apart = F.col("media") - F.col("todas")
    return (
        states.select("n", "media", "m2", total.alias("filas"), mean.alias("todas"))
        .agg(
            F.max("filas").alias("n"),
            F.max("todas").alias("media"),
            F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
        )
    )


class FitState:
    """The states of a fact table's months, in versions."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = VersionedTable(spark, root)

    def update(self, fact: DataFrame, months: Sequence[str] = ()) -> Version:
        """Measure whole months of clean facts, which replaces what was known of them.

        ``months`` names those that may have lost all their rows.
        """
        before = self.store.latest()
        number = F.lit(before.number + 1).cast("long").alias(LOAD)
        volumes = volume_states(fact)
        if months:
            spark = fact.sparkSession
            gone = spark.createDataFrame([(m,) for m in months], f"{MONTH} string")
            volumes = volumes.join(F.broadcast(gone), MONTH, "full").fillna(
                {"n": 0, "media": 0.0, "m2": 0.0}
            )
        parts = [
            self.store.write(rows.withColumn(LOAD, number).select(*schema.names), kind)
            for rows, schema, kind in (
                (volumes, _VOLUME_SCHEMA, _VOLUMES),
                (price_states(fact), _PRICE_SCHEMA, _PRICES),
            )
        ]
        return self.store.publish(before, parts=(*before.parts, *parts))

    def _newest(self, version: Version | None) -> tuple[DataFrame, DataFrame]:
        """The states that count: of each month those of its last load."""
        version = version or self.store.latest()
        volumes = self.store.read(version, _VOLUMES, _VOLUME_SCHEMA)
        last = volumes.groupBy(MONTH).agg(F.max(LOAD).alias(LOAD))
        volumes = lookup_join(volumes, last, [MONTH, LOAD], "left_semi")
        prices = self.store.read(version, _PRICES, _PRICE_SCHEMA)
        return volumes, lookup_join(prices, last, [MONTH, LOAD], "left_semi")

    def bounds_frame(self, k: float, version: Version | None = None) -> DataFrame:
        """Mean, sample deviation and the interval of ``k`` deviations."""
        found = merged_moments(self._newest(version)[0].drop("boceto"))
        stddev = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev")
        stats = found.select(F.col("media").alias("mean"), stddev)
        return stats.select(
            "mean",
            "stddev",
            (F.col("mean") - k * F.col("stddev")).alias("low"),
            (F.col("mean") + k * F.col("stddev")).alias("high"),
        )

    def bounds(self, k: float = 3.0, version: Version | None = None) -> Bounds:
        return Bounds(*self.bounds_frame(k, version).first())

    def average_prices(self, version: Version | None = None) -> DataFrame:
        """Average price per product over valid sales; products without one absent."""
        average = F.sum("suma") / F.sum("n")
        prices = self._newest(version)[1]
        return prices.groupBy("Producto_ID").agg(average.alias("Precio_Promedio_Producto"))

    def price_quantiles(self, shares: Sequence[float], version: Version | None = None) -> DataFrame:
        """``cuantil`` and ``valor`` of the positive prices, their ranks off by
        RANK_ERROR at most; NULL without any."""
        sketches = self._newest(version)[0].filter(F.col("boceto").isNotNull())
        whole = sketches.agg(F.kll_merge_agg_double("boceto").alias("boceto"))
        known = F.kll_sketch_get_n_double("boceto") > 0
        found = [
            F.struct(
                F.lit(float(q)).alias("cuantil"),
                F.when(
                    known, F.kll_sketch_get_quantile_double("boceto", F.lit(float(q)))
                ).alias("valor"),
            )
            for q in shares
        ]
        return whole.select(F.inline(F.array(*found)))


def rank_errors(df: DataFrame, column: str, quantiles: DataFrame) -> DataFrame:
    """``cuantil, valor, error``: how far each value's rank is from its share, 0 where
    equal values reach over it."""
    values = df.select(F.col(column).alias("__x")).filter(F.col("__x").isNotNull())
    listed = [(r.cuantil, r.valor) for r in quantiles.collect()]
    n = F.count(F.lit(1))
    return values.agg(
        F.array(
            *[
                F.struct(
                    F.lit(q).alias("cuantil"),
                    F.lit(v).cast("double").alias("valor"),
                    F.greatest(
                        F.count_if(F.col("__x") < v) / n - q,
                        q - F.count_if(F.col("__x") <= v) / n,
                        F.lit(0.0),
                    ).alias("error"),
                )
                for q, v in listed
            ]
        ).alias("todos")
    ).select(F.inline("todos"))
