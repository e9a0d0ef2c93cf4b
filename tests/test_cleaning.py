import datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from alambique.functions.rules import CLASSES
from alambique.operators import integrity
from alambique.operators.dedup import duplicate_keys, keep_one
from alambique.operators.stats import outlier_bounds, within_bounds
from alambique.plans import cleaning
from alambique.plans.star_views import VIEW_REGIONS, star
from alambique.schemas import DATE_DIM, FACT, PRODUCT_DIM, STORE_DIM, source_schema
from alambique.schemas import target_schema

DATE = datetime.date


def frame(spark, table, rows):
    return spark.createDataFrame(rows, source_schema(table))


def day(key, date="2024-01-05", month="Enero", week=1):
    return (key, date, 2024, 1, month, week, "2024Q1", 1.0)


def sale(store=1, product=1, key="20240105", share=0.9, price=2.0, oos=0, v=5, w=10.0):
    return (store, product, key, 0.9, share, price, oos, v, w)


@pytest.fixture(scope="module")
def dirty(spark, small_dir):
    return star(spark, small_dir)


def test_dates_without_any_valid_key(spark):
    """Keys that are all NULL are repaired as well."""
    df = frame(spark, DATE_DIM, [day(None), day(None, "06/01/2024")])
    keys = {r.Fecha_ID for r in cleaning.clean_dim_tiempo(df).collect()}
    assert keys == {"20240105", "20240106"}


def test_dates_beyond_repair_are_dropped_and_keys_unique(spark):
    rows = [
        day("ID_ERRONEO", None),
        day(None, "no date"),
        day(" 20240105 ", "no date", "ENE."),
        day("20240105", "2024-01-05", "enero"),
    ]
    (row,) = cleaning.clean_dim_tiempo(frame(spark, DATE_DIM, rows)).collect()
    assert (row.Fecha_ID, row.Fecha, row.Nombre_Mes) == (
        "20240105",
        DATE(2024, 1, 5),
        "Enero",
    )


def test_unknown_date_member(spark):
    df = frame(spark, DATE_DIM, [day("20240105"), day("19000101", None)])
    clean = cleaning.clean_dim_tiempo(df, add_unknown_date=True)
    rows = {r.Fecha_ID: r for r in clean.collect()}
    assert set(rows) == {"20240105", "19000101"}
    assert rows["19000101"].Fecha == DATE(1900, 1, 1)
    assert rows["19000101"].Nombre_Mes == "Enero"


def test_sentinel_facts_survive_with_the_unknown_date(spark):
    tables = {
        DATE_DIM: frame(spark, DATE_DIM, [day("20240105")]),
        STORE_DIM: frame(spark, STORE_DIM, [(1, "norte", "x", 1.0)]),
        PRODUCT_DIM: frame(spark, PRODUCT_DIM, [(1, "m", "s", "s", "e", "t", 2.0, 1.0)]),
        FACT: frame(spark, FACT, [sale(), sale(key=None)]),
    }
    assert cleaning.clean_all(tables)[FACT].count() == 1
    assert cleaning.clean_all(tables, add_unknown_date=True)[FACT].count() == 2
    assert cleaning.clean_all(tables, enforce_integrity=False)[FACT].count() == 2


def test_stores(spark):
    rows = [(1, "NORTÉ ", "x", 1.0), (1, "NORTÉ ", "x", 1.0), (2, "occidente", "x", 1.0)]
    clean = cleaning.clean_dim_tienda(frame(spark, STORE_DIM, rows)).collect()
    assert sorted((r.Tienda_ID, r.Region, r.Region_original) for r in clean) == [
        (1, "Norte", "NORTÉ "),
        (2, "Occidente", "occidente"),
    ]


def test_a_good_copy_of_a_product_survives_a_bad_one(spark):
    rows = [
        (1, None, "s", "s", "e", "t", 1.0, 1.0),
        (1, "m", "s", "s", "e", "t", 1.0, 1.0),
        (2, "m", "s", "s", "e", "t", 0.0, 1.0),
        (3, "m", "s", "s", "e", "t", None, 1.0),
        (None, "m", "s", "s", "e", "t", 1.0, 1.0),
    ]
    clean = cleaning.clean_dim_producto(frame(spark, PRODUCT_DIM, rows)).collect()
    assert [(r.Producto_ID, r.Marca) for r in clean] == [(1, "m")]


def test_keep_one_prefers_values_over_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (1, "b", 2), (1, "a", None), (1, "a", 3), (None, "z", 1)],
        "k int, a string, b int",
    )
    assert sorted(map(tuple, keep_one(df, "k").collect()), key=str) == [
        (1, "a", 3),
        (None, "z", 1),
    ]
    assert duplicate_keys(df, "k").collect()[0].filas == 4


def test_fact_prices(spark):
    """Averages over valid sales only; the median for a product without one."""
    rows = [
        sale(product=1, price=2.0),
        sale(product=1, price=4.0),
        sale(product=1, price=100.0, oos=1),
        sale(product=1, price=None, w=None),
        sale(product=2, price=None),
        sale(product=3, price=-1.0),
        sale(product=3, price=-1.0, v=-2, w=2.0),
    ]
    clean = cleaning.clean_fact_ventas(frame(spark, FACT, rows))
    assert clean.columns == target_schema(FACT).names
    got = {
        (r.Producto_ID, r.Precio_Original, r.Ventas_Volumen): (
            r.Precio,
            r.Precio_Promedio_Producto,
            r.Tipo_Transaccion,
            r.Ventas_Valor,
        )
        for r in clean.collect()
    }
    # Median of the positive prices 2, 4, 100 is 4.
    assert got[1, None, 5] == (3.0, 3.0, "ANOMALO", 15.0)
    assert got[2, None, 5] == (4.0, 4.0, "ANOMALO", 20.0)
    assert got[3, -1.0, 5] == (4.0, 4.0, "ANOMALO", 20.0)
    assert got[3, -1.0, -2] == (-1.0, 4.0, "AJUSTE_INVENTARIO", 2.0)
    assert got[1, 100.0, 5] == (100.0, 3.0, "VENTA_NORMAL", 500.0)


def test_fact_without_any_price(spark):
    rows = [sale(price=None), sale(price=-1.0), sale(price=-1.0, v=-1)]
    raw = frame(spark, FACT, rows)
    prices = [r.Precio for r in cleaning.clean_fact_ventas(raw).collect()]
    assert sorted(prices, key=str) == [-1.0, None, None]
    assert cleaning.clean_fact_ventas(raw, remove_null_precio=True).count() == 0


@pytest.mark.parametrize("priced", [True, False])
def test_price_filter_on_raw_columns(spark, priced):
    """Dropping on the raw price keeps exactly the rows whose repaired one is > 0."""
    cases = product([2.0, 0.0, -1.0, None], [5, -5, 0, None], [1, 2])
    rows = [sale(product=i, price=p, v=v, w=7.0) for p, v, i in cases]
    rows = [r for r in rows if priced or r[5] != 2.0]
    raw = frame(spark, FACT, rows)
    fit = cleaning.fit_fact(raw, cleaning.FactOptions(remove_null_precio=True))
    repaired = cleaning.repair_fact(raw, fit.prices).filter("Precio > 0")
    expected = cleaning.conform(repaired, FACT)
    assert fit.prices.complete is priced
    assert sorted(map(str, cleaning.apply_fact(raw, fit).collect())) == sorted(
        map(str, expected.collect())
    )


def test_fact_options(spark):
    rows = [
        sale(),
        sale(v=None),
        sale(share=None),
        sale(share=0.5),
        sale(store=None),
        sale(product=None),
    ]
    raw = frame(spark, FACT, rows)
    clean = cleaning.clean_fact_ventas(raw)
    assert clean.count() == 4
    assert clean.filter("Distribucion_Ponderada IS NULL").count() == 0
    kept = cleaning.clean_fact_ventas(raw, impute_distribucion=False)
    assert kept.filter("Distribucion_Ponderada IS NULL").count() == 1
    assert cleaning.clean_fact_ventas(raw, remove_null_volumen=True).count() == 3
    same = cleaning.clean_fact_ventas(raw, recalculate_valor=False)
    assert same.filter("Ventas_Valor <=> Ventas_Valor_Original").count() == 4
    approximate = cleaning.clean_fact_ventas(raw, median="approx")
    assert sorted(map(str, approximate.collect())) == sorted(map(str, clean.collect()))


def test_outliers(spark):
    raw = frame(spark, FACT, [sale(v=v) for v in [1] * 20 + [1000, None]])
    clean = cleaning.clean_fact_ventas(raw, remove_outliers=True)
    assert {r.Ventas_Volumen for r in clean.collect()} == {1}
    one = raw.limit(1)
    bounds = outlier_bounds(one, "Ventas_Volumen")
    assert bounds.stddev is None
    assert one.filter(within_bounds(F.col("Ventas_Volumen"), bounds)).count() == 1


def test_empty_tables(spark):
    empty = {t: spark.createDataFrame([], source_schema(t)) for t in (FACT, DATE_DIM)}
    assert cleaning.clean_fact_ventas(empty[FACT]).count() == 0
    assert set(cleaning.clean_all(empty)) == {FACT, DATE_DIM}


def test_missing_tables_skip_integrity(spark):
    clean = cleaning.clean_all({FACT: frame(spark, FACT, [sale()])})
    assert clean[FACT].count() == 1


def test_report_adds_up(spark, dirty):
    report = cleaning.cleaning_report(dirty, region_labels=VIEW_REGIONS)
    values = {(r.tabla, r.metrica): r.valor for r in report.collect()}
    clean = cleaning.clean_all(
        dirty, region_labels=VIEW_REGIONS, enforce_integrity=False
    )
    for name, df in clean.items():
        assert values[name, "final_count"] == df.count()
        assert values[name, "initial_count"] == dirty[name].count()
        kept = values[name, "initial_count"] - values[name, "removed"]
        assert kept == values[name, "final_count"]
    kinds = sum(values[FACT, f"tipo_{c.lower()}"] for c in CLASSES)
    assert kinds == values[FACT, "final_count"]
    for fault in ("fecha_id_nulos", "fecha_id_malformados", "precio_imputados"):
        assert values[FACT, fault] > 0


def test_cleaning_twice_changes_no_label_or_key(spark, dirty):
    stores = cleaning.clean_dim_tienda(dirty[STORE_DIM], VIEW_REGIONS)
    again = cleaning.clean_dim_tienda(stores.drop("Region_original"), VIEW_REGIONS)
    columns = ["Tienda_ID", "Region", "Formato_Tienda"]
    assert stores.select(columns).exceptAll(again.select(columns)).isEmpty()
    dates = cleaning.clean_dim_tiempo(dirty[DATE_DIM])
    text = dates.withColumn("Fecha", F.col("Fecha").cast("string"))
    assert cleaning.clean_dim_tiempo(text).exceptAll(dates).isEmpty()


def test_integrity_splits_the_fact(spark, dirty):
    dims = {
        DATE_DIM: cleaning.clean_dim_tiempo(dirty[DATE_DIM]),
        STORE_DIM: cleaning.clean_dim_tienda(dirty[STORE_DIM], VIEW_REGIONS),
        PRODUCT_DIM: cleaning.clean_dim_producto(dirty[PRODUCT_DIM]),
    }
    kept = integrity.enforce(dirty[FACT], dims)
    lost = integrity.orphans(dirty[FACT], dims)
    assert kept.count() + lost.count() == dirty[FACT].count()
    counts = {r.clave: r.huerfanos for r in integrity.orphan_counts(dirty[FACT], dims).collect()}
    assert counts.pop("total") == sum(counts.values()) == lost.count()
    assert all(counts.values())
