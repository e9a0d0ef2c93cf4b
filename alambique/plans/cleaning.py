"""Cleaning of the four star-schema tables.

The fact table is cleaned in two steps. ``fit_fact`` measures it: the average
price per product, written to shared storage, and a few scalars. ``apply_fact``
is then one lazy plan without an aggregate, which a write or a query can pull
through a single scan; ``fact_report`` counts what it did in another.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.functions import dates, rules
from alambique.functions.text import REGION_LABELS, month_label, region_label
from alambique.operators import integrity
from alambique.operators.dedup import keep_one
from alambique.operators.joins import lookup_join
from alambique.operators.quantiles import approx_quantile, exact_quantile
from alambique.operators.stats import (
    Bounds,
    outlier_bounds,
    product_profile,
    within_bounds,
)
from alambique.schemas import (
    DATE_DIM,
    FACT,
    PRODUCT_DIM,
    STORE_DIM,
    UNKNOWN_DATE,
    target_schema,
)
from alambique.storage import (
    Measured,
    materialize,
    materialize_measured,
    run_together,
)

_UNKNOWN_MEMBER = UNKNOWN_DATE[:4] + "-" + UNKNOWN_DATE[4:6] + "-" + UNKNOWN_DATE[6:]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of the target table, by name, in its order and types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target_schema(table)]
    )


# -- Dimensions ---------------------------------------------------------------


def clean_dim_tiempo(
    df: DataFrame, date_format: str = "yyyy-MM-dd", add_unknown_date: bool = False
) -> DataFrame:
    """Dates parsed, keys repaired from them, month names canonical, keys unique.

    ``add_unknown_date`` adds the member that facts without a date refer to, so
    that they survive the integrity check.
    """
    parsed = _repair_dates(df, date_format).filter(F.col("Fecha_ID").isNotNull())
    clean = keep_one(
        parsed.withColumn("Nombre_Mes", month_label(F.col("Nombre_Mes"))), "Fecha_ID"
    )
    if not add_unknown_date:
        return clean
    day = F.lit(_UNKNOWN_MEMBER).cast("date")
    member = df.sparkSession.range(1).select(
        *[
            c.cast(clean.schema[name].dataType).alias(name)
            for name, c in dates.calendar_columns(day).items()
        ]
    )
    return clean.filter(F.col("Fecha_ID") != UNKNOWN_DATE).unionByName(member)


def _repair_dates(df: DataFrame, date_format: str) -> DataFrame:
    parsed = df.withColumn("Fecha", dates.parse_date(F.col("Fecha"), date_format))
    return parsed.withColumn(
        "Fecha_ID", dates.repaired_date_key(F.col("Fecha_ID"), F.col("Fecha"))
    )


def clean_dim_tienda(
    df: DataFrame, labels: Mapping[str, str] = REGION_LABELS
) -> DataFrame:
    """Regions canonical with the original kept, store keys unique."""
    labelled = df.withColumns(
        {
            "Region": region_label(F.col("Region"), labels),
            "Region_original": F.col("Region"),
        }
    )
    return keep_one(labelled, "Tienda_ID")


def clean_dim_producto(df: DataFrame) -> DataFrame:
    """Products with a key, a brand and a positive base price, keys unique."""
    return keep_one(df.filter(_valid_product()), "Producto_ID")


def _valid_product() -> Column:
    required = F.col("Producto_ID").isNotNull() & F.col("Marca").isNotNull()
    return required & F.coalesce(F.col("Precio_Base") > 0, F.lit(False))


# -- Fact ---------------------------------------------------------------------


@dataclass(frozen=True)
class FactOptions:
    """Choices of the fact cleaning; the defaults remove no row for its values.

    ``median`` is ``exact`` or ``approx``; the latter takes one pass and is off
    by at most a rank share of 1/10,000.
    """

    remove_null_precio: bool = False
    remove_null_volumen: bool = False
    impute_distribucion: bool = True
    recalculate_valor: bool = True
    remove_outliers: bool = False
    outlier_std_threshold: float = 3.0
    median: str = "exact"

    def quantile(self, df: DataFrame, column: str) -> float | None:
        how = {"exact": exact_quantile, "approx": approx_quantile}[self.median]
        return how(df, column, 0.5)


#: Options of ``clean_all`` when none are given.
STRICT = FactOptions(remove_null_precio=True, remove_null_volumen=True)


@dataclass(frozen=True)
class Prices:
    """Average price per product, and the median for products without one."""

    averages: Measured
    fallback: float | None
    products_missing: int
    null_distributions: int

    @property
    def complete(self) -> bool:
        """Every product has a price to impute; otherwise none has."""
        return self.fallback is not None or not self.products_missing


@dataclass(frozen=True)
class FactFit:
    """What the cleaning needs to know about the whole fact table."""

    options: FactOptions
    prices: Prices
    bounds: Bounds | None
    distribution: float | None


def fit_prices(fact: DataFrame, options: FactOptions = FactOptions()) -> Prices:
    """One pass over the fact table; a second only if a product has no average."""
    products = materialize_measured(product_profile(fact), "product-prices")
    average = F.col("Precio_Promedio_Producto")
    usable = F.col("Producto_ID").isNotNull() & average.isNotNull()
    missing, nulls = products.df.agg(
        F.count_if(~usable), F.coalesce(F.sum("dist_nulas"), F.lit(0))
    ).first()
    fallback = None
    if missing:
        fallback = options.quantile(fact.filter(F.col("Precio") > 0), "Precio")
    averages = products.df.filter(usable).select(
        "Producto_ID", "Precio_Promedio_Producto"
    )
    # Fewer rows and columns than what was measured.
    return Prices(replace(products, df=averages), fallback, missing, nulls)


def with_average_price(fact: DataFrame, prices: Prices) -> DataFrame:
    """Add each product's average price, the median where there is none."""
    average = F.col("Precio_Promedio_Producto")
    return lookup_join(fact, prices.averages, "Producto_ID").withColumn(
        "Precio_Promedio_Producto",
        F.coalesce(average, F.lit(prices.fallback).cast("double")),
    )


def with_date_key(fact: DataFrame) -> DataFrame:
    """Date key trimmed, the unknown date where invalid, the original kept."""
    key = F.col("Fecha_ID")
    return fact.withColumns(
        {"Fecha_ID": dates.key_or_unknown(key), "Fecha_ID_original": key}
    )


def with_class(fact: DataFrame) -> DataFrame:
    """Transaction class and its flags, from the values before any repair."""
    kind = F.col("Tipo_Transaccion")
    classed = fact.withColumn("Tipo_Transaccion", rules.transaction_class())
    return classed.withColumns(rules.class_flags(kind))


def with_repaired_price(fact: DataFrame) -> DataFrame:
    """Impute missing and impossible prices, the original kept."""
    price = F.col("Precio")
    fixed = rules.repaired_price(
        price, F.col("Ventas_Volumen"), F.col("Precio_Promedio_Producto")
    )
    return fact.withColumns({"Precio": fixed, "Precio_Original": price})


def with_value(fact: DataFrame, recompute: bool = True) -> DataFrame:
    """Recompute the value if asked; the original is kept either way."""
    value = F.col("Ventas_Valor")
    fixed = rules.recomputed_value(
        F.col("Tipo_Transaccion"), F.col("Precio"), F.col("Ventas_Volumen")
    )
    return fact.withColumns(
        {"Ventas_Valor": fixed if recompute else value, "Ventas_Valor_Original": value}
    )


def repair_fact(
    fact: DataFrame, prices: Prices, recompute_value: bool = True
) -> DataFrame:
    """Every derived column of a clean fact; no row is removed."""
    return (
        fact.transform(with_date_key)
        .transform(with_average_price, prices)
        .transform(with_class)
        .transform(with_repaired_price)
        .transform(with_value, recompute_value)
    )


def fit_fact(fact: DataFrame, options: FactOptions = FactOptions()) -> FactFit:
    """Measure the fact table; columns a statistic does not need are not read."""
    prices = fit_prices(fact, options)
    bounds = distribution = None
    rows = fact.filter(_priced(options, prices) & _counted(options))
    if options.remove_outliers:
        bounds = outlier_bounds(rows, "Ventas_Volumen", options.outlier_std_threshold)
        rows = rows.filter(within_bounds(F.col("Ventas_Volumen"), bounds))
    if options.impute_distribucion and prices.null_distributions:
        distribution = options.quantile(rows, "Distribucion_Ponderada")
    return FactFit(options, prices, bounds, distribution)


def _priced(
    options: FactOptions, prices: Prices, price: str = "Precio"
) -> Column:
    """Rows whose repaired price is positive, told from the raw price.

    Averages and medians of positive prices are positive, so a row that will be
    imputed passes if there is anything to impute. That needs no join.
    """
    if not options.remove_null_precio:
        return F.lit(True)
    raw, volume = F.col(price), F.col("Ventas_Volumen")
    passes = raw > 0
    if prices.complete:
        passes = passes | raw.isNull() | (volume > 0)
    return F.coalesce(passes, F.lit(False))


def _counted(options: FactOptions) -> Column:
    if not options.remove_null_volumen:
        return F.lit(True)
    return F.col("Ventas_Volumen").isNotNull()


def _usual(fit: FactFit) -> Column:
    if fit.bounds is None:
        return F.lit(True)
    return within_bounds(F.col("Ventas_Volumen"), fit.bounds)


def _keyed() -> Column:
    return F.col("Tienda_ID").isNotNull() & F.col("Producto_ID").isNotNull()


def impute(column: str, value: float) -> Column:
    return F.coalesce(F.col(column), F.lit(value))


def apply_fact(fact: DataFrame, fit: FactFit) -> DataFrame:
    """The clean fact table, as one plan over one scan.

    Rows are dropped on their raw columns, before the join and the repairs.
    """
    options = fit.options
    wanted = _priced(options, fit.prices) & _counted(options) & _usual(fit) & _keyed()
    kept = repair_fact(fact.filter(wanted), fit.prices, options.recalculate_valor)
    if fit.distribution is not None:
        kept = kept.withColumn(
            "Distribucion_Ponderada", impute("Distribucion_Ponderada", fit.distribution)
        )
    return conform(kept, FACT)


def clean_fact_ventas(df: DataFrame, **options) -> DataFrame:
    """Clean the fact table; keywords are the fields of ``FactOptions``."""
    return apply_fact(df, fit_fact(df, FactOptions(**options)))


def clean_all(
    tables: Mapping[str, DataFrame],
    enforce_integrity: bool = True,
    fact_options: FactOptions | Mapping | None = None,
    region_labels: Mapping[str, str] = REGION_LABELS,
    date_format: str = "yyyy-MM-dd",
    add_unknown_date: bool = False,
) -> dict[str, DataFrame]:
    """Clean the tables that are there, then drop facts without their dimensions.

    The tables are cleaned at the same time. Clean dimensions are written once,
    as everything after reads them. Without ``fact_options`` rows with no usable price or volume are removed.
    """
    options = fact_options if fact_options is not None else STRICT
    if not isinstance(options, FactOptions):
        options = FactOptions(**options)
    cleaners = {
        DATE_DIM: lambda df: clean_dim_tiempo(df, date_format, add_unknown_date),
        STORE_DIM: lambda df: clean_dim_tienda(df, region_labels),
        PRODUCT_DIM: clean_dim_producto,
        FACT: lambda df: apply_fact(df, fit_fact(df, options)),
    }

    def clean_one(name: str) -> DataFrame:
        cleaned = cleaners[name](tables[name])
        return cleaned if name == FACT else materialize(cleaned, name)

    wanted = [name for name in cleaners if name in tables]
    clean = run_together({n: lambda n=n: clean_one(n) for n in wanted})
    if enforce_integrity and len(clean) == len(cleaners):
        clean[FACT] = integrity.enforce(clean[FACT], clean)
    return clean


# -- Report -------------------------------------------------------------------


def cleaning_report(
    tables: Mapping[str, DataFrame],
    fact_options: FactOptions = STRICT,
    region_labels: Mapping[str, str] = REGION_LABELS,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """(tabla, metrica, valor, porcentaje) rows; the share is of initial rows."""
    key, date = F.col("Fecha_ID"), F.col("Fecha")
    raw_date = tables[DATE_DIM].withColumns({"__key": key, "__date": date})
    raw_key = dates.trimmed_key(F.col("__key"))
    date_report = _dimension_report(
        DATE_DIM,
        _repair_dates(raw_date, date_format),
        "Fecha_ID",
        key.isNotNull(),
        {
            "fecha_sin_formato": date.isNull() & F.col("__date").isNotNull(),
            "fecha_id_nulos": raw_key.isNull(),
            "fecha_id_malformados": raw_key.isNotNull() & ~dates.is_date_key(raw_key),
            "fecha_id_corregidos": ~key.eqNullSafe(raw_key) & key.isNotNull(),
        },
    )
    region = region_label(F.col("Region"), region_labels)
    store_report = _dimension_report(
        STORE_DIM,
        tables[STORE_DIM],
        "Tienda_ID",
        F.lit(True),
        {"region_normalizadas": ~F.col("Region").eqNullSafe(region)},
    )
    base = F.col("Precio_Base")
    product_report = _dimension_report(
        PRODUCT_DIM,
        tables[PRODUCT_DIM],
        "Producto_ID",
        _valid_product(),
        {
            "marca_nulos": F.col("Marca").isNull(),
            "precio_base_nulos": base.isNull(),
            "precio_base_no_positivo": base <= 0,
        },
    )
    fact = tables[FACT]
    reports = [date_report, store_report, product_report]
    reports.append(fact_report(fact, fit_fact(fact, fact_options)))
    whole = reports[0]
    for report in reports[1:]:
        whole = whole.unionByName(report)
    return whole


def _dimension_report(
    table: str, rows: DataFrame, key: str, valid: Column, faults: dict[str, Column]
) -> DataFrame:
    per_key = rows.groupBy(F.col(key), valid.alias("__valid")).agg(
        F.count("*").alias("__rows"),
        *[F.count_if(c).alias(name) for name, c in faults.items()],
    )
    rows_of, is_valid = F.col("__rows"), F.col("__valid")
    metrics = {
        "initial_count": F.sum(rows_of),
        "final_count": F.count_if(is_valid),
        "removed": F.sum(rows_of) - F.count_if(is_valid),
        "duplicates": F.count_if(is_valid & (rows_of > 1)),
        **{name: F.sum(name) for name in faults},
    }
    return _report_rows(per_key, table, metrics)


def fact_metrics(fit: FactFit) -> dict[str, Column]:
    """Aggregates over ``repair_fact``; also usable with ``DataFrame.observe``."""
    options = fit.options
    price, raw_price = F.col("Precio"), F.col("Precio_Original")
    volume, kind = F.col("Ventas_Volumen"), F.col("Tipo_Transaccion")
    raw_key = F.col("Fecha_ID_original")
    valid_key = dates.is_date_key(dates.trimmed_key(raw_key))
    priced = _priced(options, fit.prices, "Precio_Original")
    before_outliers = priced & _counted(options)
    kept = before_outliers & _usual(fit) & _keyed()
    changed = rules.value_changed(F.col("Ventas_Valor"), F.col("Ventas_Valor_Original"))
    return {
        "initial_count": F.count(F.lit(1)),
        "final_count": F.count_if(kept),
        "removed": F.count_if(~kept),
        "fecha_id_nulos": F.count_if(raw_key.isNull()),
        "fecha_id_malformados": F.count_if(raw_key.isNotNull() & ~valid_key),
        "precio_nulo_antes": F.count_if(raw_price.isNull()),
        "precio_no_positivo_antes": F.count_if(raw_price <= 0),
        "precio_imputados": F.count_if(~price.eqNullSafe(raw_price)),
        "precio_nulo_despues": F.count_if(price.isNull()),
        "precio_no_positivo_despues": F.count_if(price <= 0),
        "volumen_nulo": F.count_if(volume.isNull()),
        "dist_ponderada_nula": F.count_if(F.col("Distribucion_Ponderada").isNull()),
        "valor_discrepancias": F.count_if(changed),
        "outliers_removed": F.count_if(before_outliers & ~_usual(fit)),
        **{f"tipo_{c.lower()}": F.count_if(kept & (kind == c)) for c in rules.CLASSES},
    }


def fact_report(fact: DataFrame, fit: FactFit) -> DataFrame:
    repaired = repair_fact(fact, fit.prices, fit.options.recalculate_valor)
    return _report_rows(repaired, FACT, fact_metrics(fit))


def _report_rows(df: DataFrame, table: str, metrics: dict[str, Column]) -> DataFrame:
    one_row = df.agg(
        *[F.coalesce(c, F.lit(0)).alias(name) for name, c in metrics.items()]
    )
    share = F.try_divide(F.lit(100.0), F.col("initial_count"))
    rows = [
        F.struct(
            F.lit(table).alias("tabla"),
            F.lit(name).alias("metrica"),
            F.col(name).cast("long").alias("valor"),
            (F.col(name) * share).alias("porcentaje"),
        )
        for name in metrics
    ]
    return one_row.select(F.inline(F.array(*rows)))


def summary(report: DataFrame) -> DataFrame:
    """Per table: rows before and after, removed, and the share removed."""
    names = ["initial_count", "final_count", "removed"]
    picked = [
        F.max(F.when(F.col("metrica") == n, F.col("valor"))).alias(n) for n in names
    ]
    share = F.max(F.when(F.col("metrica") == "removed", F.col("porcentaje")))
    return report.groupBy("tabla").agg(*picked, share.alias("porcentaje"))
