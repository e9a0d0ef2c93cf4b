import pytest
from pyspark.sql import functions as F

from alambique.plans.star_views import star
from alambique.schemas import DATE_DIM, FACT, STORE_DIM, TABLES, source_schema
from alambique.sinks import export
from alambique.sinks.export import JdbcConnection
from alambique.sources import files

CONNECTION = JdbcConnection("jdbc:x", "user", "secret", "some.Driver")


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_schemas():
    assert [len(source_schema(t)) for t in TABLES] == [8, 4, 8, 9]
    with pytest.raises(ValueError, match="no schema"):
        source_schema("otra")


def test_load_table(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "Tienda_ID;Region;Formato_Tienda;Atractivo_Factor",
        "1; Norte ;x;0.5",
        "abc;Sur;x;1.5",
        "2.0;;x;no",
    )
    rows = files.load_table(spark, STORE_DIM, path, delimiter=";").collect()
    assert [tuple(r) for r in rows] == [
        (1, "Norte", "x", 0.5),
        (None, "Sur", "x", 1.5),
        (None, None, "x", None),
    ]


def test_quarantine_does_not_depend_on_the_columns_used(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "Tienda_ID,Region,Formato_Tienda,Atractivo_Factor",
        "1,Norte,x,0.5",
        "abc,Sur,x,1.5",
        "3,Este",
        "4,Oeste,x,1.0,extra",
    )
    df = files.load_table(spark, STORE_DIM, path, keep_corrupt=True)
    good, bad = files.split_corrupt(df)
    assert good.columns == source_schema(STORE_DIM).names
    assert [r.Region for r in good.select("Region").collect()] == ["Norte"]
    lines = bad.select("Region", files.CORRUPT).collect()
    assert {r[files.CORRUPT] for r in lines} == {
        "abc,Sur,x,1.5",
        "3,Este",
        "4,Oeste,x,1.0,extra",
    }


def test_missing_files_are_skipped(spark, tmp_path):
    write(
        tmp_path / "p_dim_tienda.csv",
        "Tienda_ID,Region,Formato_Tienda,Atractivo_Factor",
        "1,Norte,x,0.5",
    )
    assert files.load_table(spark, FACT, str(tmp_path / "none.csv")) is None
    loaded = files.load_all_tables(spark, str(tmp_path), "p")
    assert list(loaded) == [STORE_DIM]
    assert [tuple(r) for r in files.table_counts(loaded).collect()] == [(STORE_DIM, 1)]
    with pytest.raises(ValueError, match="no schema"):
        files.load_table(spark, "otra", str(tmp_path))


@pytest.mark.parametrize(("number", "compression"), [(1, None), (3, "gzip")])
def test_csv_files(spark, tmp_path, number, compression):
    df = spark.range(100).select(F.col("id"), F.lit("a,b").alias("v"))
    path = tmp_path / "out"
    stats = export.export_to_csv(df, str(path), num_files=number, compression=compression)
    assert (stats.exito, stats.filas, stats.archivos) == (True, 100, number)
    suffix = "*.csv.gz" if compression else "*.csv"
    assert len(list(path.glob(suffix))) == number
    back = spark.read.schema(df.schema).csv(str(path), header=True)
    assert back.exceptAll(df).isEmpty() and back.count() == 100
    export.export_to_csv(df, str(path), mode="append")
    assert spark.read.csv(str(path), header=True).count() == 200


def test_nothing_to_export(spark, tmp_path):
    path = str(tmp_path / "out")
    export.export_to_csv(spark.range(5), path)
    empty = spark.range(5).filter("id > 9")
    for df in (None, empty):
        stats = export.export_to_csv(df, path)
        assert not stats.exito and stats.error
    assert spark.read.csv(path, header=True).count() == 5  # not overwritten


def test_failure_is_reported(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).alias("v"), "id")
    bad = spark.range(1).select(F.lit("ok").alias("v"), "id").unionByName(bad)
    stats = export.export_to_csv(bad, str(tmp_path / "out"))
    assert not stats.exito and "boom" in stats.error


def test_parquet_by_month(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("Mes"))
    path = tmp_path / "out"
    assert export.export_to_parquet(df, str(path), ["Mes"]).filas == 100
    assert {p.name for p in path.glob("Mes=*")} == {"Mes=0", "Mes=1", "Mes=2"}
    one = spark.read.parquet(str(path)).filter("Mes = 1")
    assert one.count() == 33
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Mes" in plan


def test_several_tables(spark, tmp_path, small_dir):
    tables = {n: df for n, df in star(spark, small_dir).items() if n in (STORE_DIM, DATE_DIM)}
    done = export.export_multiple_tables_to_csv(tables, str(tmp_path))
    stats = export.export_stats(spark, done.values())
    assert stats.filter("exito AND filas > 0 AND segundos > 0").count() == 2


class Database:
    """Stands in for the JDBC writer and reader; fails a number of times."""

    def __init__(self, failures=0, arrived=None):
        self.failures, self.arrived = failures, arrived
        self.saved, self.calls, self.waits = [], [], []

    def save(self, df, options, mode):
        self.calls.append((options, mode, df.rdd.getNumPartitions()))
        if len(self.calls) <= self.failures:
            raise RuntimeError("connection lost")
        self.saved = sorted(r.id for r in df.collect())

    def read(self, spark, options):
        return self.arrived

    def export(self, df, **options):
        return export.export_to_sql(
            df, "t", CONNECTION, save=self.save, read=self.read, wait=self.waits.append, **options
        )


def test_jdbc_options(spark):
    database = Database()
    stats = database.export(spark.range(100), max_partitions=4, batchsize=500)
    options, mode, partitions = database.calls[0]
    assert options == {
        "url": "jdbc:x",
        "dbtable": "t",
        "user": "user",
        "password": "secret",
        "driver": "some.Driver",
        "batchsize": "500",
        "isolationLevel": "READ_COMMITTED",
        "numPartitions": "4",
        "queryTimeout": "0",
    }
    assert (mode, partitions, stats.exito, stats.intentos) == ("append", 4, True, 1)


def test_jdbc_overwrite_is_retried(spark):
    database = Database(failures=2)
    stats = database.export(spark.range(10), mode="overwrite")
    assert (stats.exito, stats.intentos) == (True, 3)
    assert database.waits == [20, 40]
    database = Database(failures=3)
    stats = database.export(spark.range(10), mode="overwrite")
    assert (stats.exito, stats.intentos) == (False, 3)
    assert "connection lost" in stats.error


def test_jdbc_append_never_doubles_rows(spark):
    database = Database(failures=1)
    assert not database.export(spark.range(10)).exito
    assert len(database.calls) == 1
    database = Database(failures=1, arrived=spark.range(4))
    assert database.export(spark.range(10), key_columns=["id"]).exito
    assert database.saved == [4, 5, 6, 7, 8, 9]


def test_jdbc_needs_settings(spark):
    stats = export.export_to_sql(spark.range(1), "t", JdbcConnection("jdbc:x"))
    assert not stats.exito and "required" in stats.error
    empty = Database().export(spark.range(0))
    assert not empty.exito


def test_several_tables_over_jdbc(spark):
    database = Database()
    done = export.export_multiple_tables_to_sql(
        {"a": spark.range(3), "b": spark.range(2)},
        CONNECTION,
        table_prefix="clean_",
        save=database.save,
    )
    assert [options["dbtable"] for options, _, _ in database.calls] == ["clean_a", "clean_b"]
    assert all(s.exito for s in done.values())
