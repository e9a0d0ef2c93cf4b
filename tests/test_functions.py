import pytest
from pyspark.sql import functions as F

from alambique.functions import dates, rules, text
from alambique.functions.draws import uniform


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    row = tuple(v for _, v in values.values())
    return spark.createDataFrame([row], ddl).select(column).first()[0]


# Volume, price, out-of-stock flag, value, class.
CLASSES = [
    (5, 2.0, 0, 10.0, "VENTA_NORMAL"),
    (5, 2.0, 1, 10.0, "VENTA_NORMAL"),
    (-5, 2.0, 1, -10.0, "DEVOLUCION"),
    (-5, None, 0, -10.0, "AJUSTE_INVENTARIO"),
    (-5, 0.0, 0, 0.0, "AJUSTE_INVENTARIO"),
    (0, 2.0, 1, None, "VENTA_PERDIDA"),
    (0, 2.0, 0, 0.0, "REGISTRO_SIN_VENTA"),
    (0, 2.0, 0, 10.0, "ANOMALO"),
    (5, None, 0, 10.0, "ANOMALO"),
    (5, 2.0, 0, None, "ANOMALO"),
    (None, 2.0, 0, 10.0, "ANOMALO"),
    (0, 2.0, None, 0.0, "ANOMALO"),
]


def test_classes_and_flags(spark):
    df = spark.createDataFrame(
        CLASSES,
        "Ventas_Volumen int, Precio double, Out_Of_Stock_Flag int, "
        "Ventas_Valor double, esperado string",
    ).withColumn("Tipo", rules.transaction_class())
    df = df.withColumns(rules.class_flags(F.col("Tipo")))
    for row in df.collect():
        assert row.Tipo == row.esperado
        flags = {label: row[flag] for flag, label in rules.FLAGS.items()}
        assert flags == {label: label == row.Tipo for label in rules.FLAGS.values()}


@pytest.mark.parametrize(
    ("price", "volume", "expected"),
    [
        (None, 5, 9.0),
        (None, -5, 9.0),
        (0.0, 5, 9.0),
        (-1.0, 5, 9.0),
        (-1.0, -5, -1.0),
        (0.0, 0, 0.0),
        (-1.0, None, -1.0),
        (3.0, 5, 3.0),
    ],
)
def test_repaired_price(spark, price, volume, expected):
    column = rules.repaired_price(F.col("p"), F.col("v"), F.lit(9.0))
    assert one(spark, column, p=("double", price), v=("int", volume)) == expected


@pytest.mark.parametrize(
    ("new", "old", "changed"),
    [(101.0, 100.0, False), (101.1, 100.0, True), (5.0, None, False), (None, 5.0, False)],
)
def test_value_changed(spark, new, old, changed):
    column = rules.value_changed(F.col("n"), F.col("o"))
    assert one(spark, column, n=("double", new), o=("double", old)) is changed


def test_value_is_zero_where_nothing_was_sold(spark):
    column = rules.recomputed_value(F.col("k"), F.lit(2.0), F.lit(3))
    assert one(spark, column, k=("string", "VENTA_PERDIDA")) == 0.0
    assert one(spark, column, k=("string", "ANOMALO")) == 6.0


@pytest.mark.parametrize(
    ("written", "iso"),
    [
        ("2024-01-15", "2024-01-15"),
        ("15/01/2024", "2024-01-15"),
        ("01/15/2024", "2024-01-15"),
        ("03/04/2024", "2024-04-03"),  # day first wins
        ("20240115", "2024-01-15"),
        ("2024/01/15", "2024-01-15"),
        ("15-01-2024", "2024-01-15"),
        ("31/02/2024", None),
        ("FECHA_INCORRECTA", None),
        (None, None),
    ],
)
def test_parse_date(spark, written, iso):
    column = dates.parse_date(F.col("t")).cast("string")
    assert one(spark, column, t=("string", written)) == iso


def test_parse_date_with_another_first_format(spark):
    column = dates.parse_date(F.col("t"), "MM/dd/yyyy").cast("string")
    assert one(spark, column, t=("string", "03/04/2024")) == "2024-03-04"


@pytest.mark.parametrize(
    ("key", "valid"),
    [("20240115", True), ("2024011", False), ("2024-X-01", False), (None, False)],
)
def test_date_key(spark, key, valid):
    assert one(spark, dates.is_date_key(F.col("k")), k=("string", key)) is valid
    expected = key if valid else "19000101"
    column = dates.key_or_unknown(F.concat(F.lit(" "), F.col("k")))
    assert one(spark, column, k=("string", key)) == expected


def test_key_repaired_from_the_date(spark):
    column = dates.repaired_date_key(F.col("k"), F.to_date(F.col("d")))
    repaired = lambda k, d: one(spark, column, k=("string", k), d=("string", d))
    assert repaired(" 20240115", None) == "20240115"
    assert repaired(None, "2024-01-05") == "20240105"
    assert repaired("ID_ERRONEO", "2024-01-05") == "20240105"
    assert repaired("ID_ERRONEO", None) is None


@pytest.mark.parametrize(
    ("key", "kind"),
    [
        ("20240115", "Numérico_8_digitos"),
        ("2024", "Numérico_otro"),
        (" 20240115", "No_numérico"),
        (None, "NULL"),
    ],
)
def test_key_class(spark, key, kind):
    assert one(spark, dates.key_class(F.col("k")), k=("string", key)) == kind


@pytest.mark.parametrize(
    ("key", "factor"), [("20230601", 1.0), ("2024-X-01", 1.0), (None, 1.0)]
)
def test_season_of_key(spark, key, factor):
    assert one(spark, dates.season_of_key(F.col("k")), k=("string", key)) == factor


@pytest.mark.parametrize(
    ("label", "month"),
    [
        ("ENERO", "Enero"),
        ("ENE.", "Enero"),
        (" sep ", "Septiembre"),
        ("may", "Mayo"),
        ("December", "Diciembre"),
        ("otro mes", "Otro Mes"),
        (None, None),
    ],
)
def test_month_label(spark, label, month):
    assert one(spark, text.month_label(F.col("t")), t=("string", label)) == month


@pytest.mark.parametrize(
    ("label", "region"),
    [
        ("NORTE", "Norte"),
        ("Nortê ", "Norte"),
        ("noröeste", "Noroeste"),
        ("OCCIDÉNTE", "Occidente"),  # not in the map
        ("", ""),
    ],
)
def test_region_label(spark, label, region):
    assert one(spark, text.region_label(F.col("t")), t=("string", label)) == region


def test_accents(spark):
    column = text.fold_accents(F.col("t"))
    assert one(spark, column, t=("string", "Ñandú ÁÉÍÓÚ ü")) == "Nandu AEIOU ü"


def test_label_tables():
    assert len(text.MONTH_LABELS) == 47
    assert len(text.REGION_LABELS) == 9


def test_draws_are_uniform_and_independent(spark):
    n = 100_000
    ids = spark.range(n).select(
        uniform(F.col("id"), 7, 1).alias("a"), uniform(F.col("id"), 7, 2).alias("b")
    )
    row = ids.agg(
        F.min("a"), F.max("a"), F.avg("a"), F.variance("a"), F.corr("a", "b")
    ).first()
    assert 0 <= row[0] < 0.001 and 0.999 < row[1] < 1
    assert abs(row[2] - 0.5) < 0.005
    assert abs(row[3] - 1 / 12) < 0.002
    assert abs(row[4]) < 0.02
    tenths = ids.groupBy(F.floor(F.col("a") * 10)).count().collect()
    assert all(abs(r["count"] - n / 10) < n / 100 for r in tenths)


def test_draws_do_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    draw = uniform(F.col("id"), 7, 3).alias("u")
    few = {(r.id, r.u) for r in ids.coalesce(1).select("id", draw).collect()}
    many = {(r.id, r.u) for r in ids.repartition(16).select("id", draw).collect()}
    assert few == many
