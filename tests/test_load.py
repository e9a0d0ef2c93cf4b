import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from alambique.operators import load
from alambique.plans import loading
from alambique.plans.loading import read_target, run_load, staged_months
from alambique.schemas import FACT, FACT_KEY, PRODUCT_DIM, target_schema
from alambique.sinks.versions import KEPT
from alambique.streaming.staged_load import drain_staging

KEYS = ("k",)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def facts(spark, rows):
    """Clean facts from (product, store, date, class, volume)."""
    df = spark.createDataFrame(
        rows,
        "Producto_ID int, Tienda_ID int, Fecha_ID string, Tipo_Transaccion string, "
        "Ventas_Volumen int",
    )
    fill = {"double": 1.0, "int": 0, "string": "x", "boolean": False}
    return df.select(
        *[
            F.col(f.name)
            if f.name in df.columns
            else F.lit(fill[f.dataType.simpleString()]).alias(f.name)
            for f in target_schema(FACT)
        ]
    )


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_new_keys_are_inserted(spark):
    staging = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")])
    target = frame(spark, [(1, "old"), (None, "old")])
    assert values(load.new_rows(staging, target, KEYS)) == [(2, "b"), (2, "c"), (3, "d")]
    first = load.new_rows(staging, target, KEYS, load.KEEP_FIRST)
    assert values(first) == [(2, "b"), (3, "d")]
    assert values(load.existing_rows(staging, target, KEYS)) == [(1, "a")]
    with pytest.raises(ValueError, match="policy"):
        load.new_rows(staging, target, KEYS, "any")


def test_loading_again_inserts_nothing(spark):
    staging = frame(spark, [(1, "a"), (2, "b"), (None, "e")])
    target = frame(spark, [(1, "old")])
    loaded = target.unionByName(load.new_rows(staging, target, KEYS))
    assert load.new_rows(staging, loaded, KEYS).isEmpty()
    assert values(load.purge_loaded(staging, loaded, KEYS)) == [(None, "e")]


@pytest.mark.parametrize(
    ("policy", "inserted", "left_out"), [("keep_all", 3, 0), ("keep_first", 2, 1)]
)
def test_counts(spark, policy, inserted, left_out):
    staging = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")])
    marked = load.mark_staging(staging, frame(spark, [(1, "x"), (1, "y")]), KEYS)
    assert marked.count() == 5
    (row,) = load.load_counts(marked, KEYS, policy).collect()
    assert tuple(row) == (5, inserted, 1, left_out, 1)
    entry = load.log_entry(load.load_counts(marked, KEYS, policy), "s", "t", "n").first()
    assert entry.Estado == "ADVERTENCIA"


def test_pruning_reads_only_staged_days(spark):
    target = facts(spark, [(1, 1, "20240101", "A", 1), (2, 1, "20240102", "A", 1)])
    staging = facts(spark, [(2, 1, "20240102", "A", 5), (3, 1, "20240102", "A", 5)])
    assert load.restrict_target(target, staging, "Fecha_ID").count() == 1
    pruned = load.new_rows(staging, target, FACT_KEY, prune_by="Fecha_ID")
    assert values(pruned) == values(load.new_rows(staging, target, FACT_KEY))


def test_run_load(spark, tmp_path):
    targets = {FACT: str(tmp_path / "facts"), PRODUCT_DIM: str(tmp_path / "products")}
    staged = {FACT: str(tmp_path / "staging")}
    log = str(tmp_path / "log")
    product = [(1, "m", "s", "s", "e", "t", 2.0, 1.0)]
    staging = {
        FACT: facts(
            spark, [(1, 1, "20240101", "A", 1), (1, 1, "20240101", "A", 2), (1, None, "x", "A", 3)]
        ),
        PRODUCT_DIM: spark.createDataFrame(product, target_schema(PRODUCT_DIM)),
    }
    staging[FACT].write.parquet(staged[FACT])
    staging[FACT] = spark.read.parquet(staged[FACT])
    entries = {r.Tabla_Destino: r for r in run_load(staging, targets, log, staged).collect()}
    assert set(entries) == {"tbl_facts", "tbl_producto"}
    fact = entries["tbl_facts"]
    assert (fact.Registros_Procesados, fact.Registros_Insertados) == (3, 2)
    assert (fact.Registros_Errores, fact.Estado) == (1, "ADVERTENCIA")
    assert fact.Ejecucion_ID and fact.Duracion_Segundos is not None and fact.Usuario
    assert read_target(spark, targets[FACT], FACT).count() == 2
    left = spark.read.parquet(staged[FACT])
    assert [r.Ventas_Volumen for r in left.collect()] == [3]

    again = facts(spark, [(1, 1, "20240101", "A", 9), (2, 1, "20240101", "A", 9)])
    (second,) = run_load({FACT: again}, targets, log).collect()
    assert (second.Registros_Insertados, second.Registros_Existentes) == (1, 1)
    assert read_target(spark, targets[FACT], FACT).count() == 3
    assert spark.read.parquet(log).count() == 3


def test_contract(spark):
    df = facts(spark, [(1, 1, "20240101", "VENTA_NORMAL", 1), (1, 1, "x", "otra", 1)])
    df = df.withColumn("Precio", F.when(F.col("Fecha_ID") == "x", 1.0)).drop("Es_Ajuste")
    found = {r.regla: r.filas for r in load.contract_violations(df, FACT).collect()}
    assert found["Precio no nulo"] == 1
    assert found["Tipo_Transaccion permitido"] == 1
    assert found["Es_Ajuste presente"] == 2
    assert found["Out_Of_Stock_Flag permitido"] == 0


def test_error_detail_of_a_common_error(spark):
    rows = spark.range(10_000).select(
        F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("v").alias("v")
    )
    errors = [load.error_rows(rows, "VALIDACION", F.lit("d"), ["k"])]
    (row,) = load.error_detail("t", errors, ["k"]).collect()
    assert row.Registros_Afectados == 10_000
    assert row.Datos_Ejemplo == '[{"k":1},{"k":2},{"k":3}]'


def test_the_target_is_read_by_month(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [(i, 1, f"2024{1 + i % 6:02d}01", "VENTA_NORMAL", 1) for i in range(60)]
    run_load({FACT: facts(spark, rows)}, {FACT: path}, str(tmp_path / "log"))
    staging = facts(spark, [(1, 1, "20240201", "VENTA_NORMAL", 1)])
    months = staged_months(staging, FACT)
    assert months == ["202402"]
    read = read_target(spark, path, FACT, months)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Mes_Carga" in text
    assert read.count() == 10 and len(read.inputFiles()) <= read_target(spark, path, FACT).count()
    assert read_target(spark, path, FACT).count() == 60


def test_staged_files_that_arrive_late_stay(spark, tmp_path):
    staged, target = str(tmp_path / "staging"), str(tmp_path / "facts")
    facts(spark, [(1, 1, "20240101", "A", 1), (None, 1, "20240101", "A", 2)]).write.parquet(staged)
    staging = spark.read.parquet(staged)
    staging.count()
    facts(spark, [(7, 1, "20240101", "A", 7)]).write.mode("append").parquet(staged)
    run_load({FACT: staging}, {FACT: target}, str(tmp_path / "log"), {FACT: staged})
    left = spark.read.parquet(staged)
    assert sorted(r.Ventas_Volumen for r in left.collect()) == [2, 7]
    assert read_target(spark, target, FACT).count() == 1


def test_a_failing_table_is_logged(spark, tmp_path):
    log = str(tmp_path / "log")
    product = spark.createDataFrame(
        [(1, "m", "s", "s", "e", "t", 2.0, 1.0)], target_schema(PRODUCT_DIM)
    )
    broken = facts(spark, [(1, 1, "20240101", "A", 1)]).drop("Fecha_ID")
    targets = {PRODUCT_DIM: str(tmp_path / "p"), FACT: str(tmp_path / "f")}
    with pytest.raises(AnalysisException):
        run_load({PRODUCT_DIM: product, FACT: broken}, targets, log)
    entries = {r.Tabla_Destino: r for r in spark.read.parquet(log).collect()}
    assert entries["tbl_producto"].Estado == "EXITOSO"
    assert entries["tbl_facts"].Estado == "ERROR" and entries["tbl_facts"].Mensaje
    detail = spark.read.parquet(f"{log}_errores").collect()
    (failed,) = [r for r in detail if r.Tipo_Error == "SISTEMA"]
    assert failed.Ejecucion_ID == entries["tbl_facts"].Ejecucion_ID and failed.Fecha_Error


def test_error_detail_is_written_by_a_run(spark, tmp_path):
    log, targets = str(tmp_path / "log"), {FACT: str(tmp_path / "f")}
    rows = [(1, 1, "20240101", "A", 1), (1, 1, "20240101", "A", 2), (None, 1, "x", "A", 3)]
    run_load({FACT: facts(spark, rows)}, targets, log)
    detail = spark.read.parquet(f"{log}_errores").collect()
    found = {(r.Tipo_Error, r.Registros_Afectados) for r in detail}
    assert found == {("VALIDACION", 1), ("DUPLICADO", 1)}
    assert all(r.Ejecucion_ID and r.Fecha_Error for r in detail)


def _staged_copies(spark, staging):
    """Four files; one key is in all of them and one in none of the target."""
    for i in range(4):
        rows = facts(spark, [(1, 1, "20240101", "A", i), (10 + i, 1, "20240102", "A", i)])
        rows.coalesce(1).write.mode("append").parquet(staging)


@pytest.mark.parametrize("policy", [load.KEEP_ALL, load.KEEP_FIRST])
def test_batches_change_nothing(spark, tmp_path, policy):
    loaded = {}
    for size in (1, 2, 1000):
        base = tmp_path / f"{policy}-{size}"
        _staged_copies(spark, str(base / "in"))
        drain_staging(
            spark, str(base / "in"), str(base / "out"), str(base / "state"),
            files_per_batch=size, policy=policy,
        )
        loaded[size] = values(read_target(spark, str(base / "out"), FACT))
    assert loaded[1] == loaded[2] == loaded[1000]
    assert len(loaded[1]) == (8 if policy == load.KEEP_ALL else 5)


def test_a_drain_that_failed_is_made_good(spark, tmp_path, monkeypatch):
    staging, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    _staged_copies(spark, staging)
    insert = loading.insert_marked

    def failing(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(loading, "insert_marked", failing)
    with pytest.raises(RuntimeError, match="lost"):
        drain_staging(spark, staging, target, state, files_per_batch=2)
    monkeypatch.setattr(loading, "insert_marked", insert)
    drain_staging(spark, staging, target, state, files_per_batch=2)
    assert read_target(spark, target, FACT).count() == 8
    assert drain_staging(spark, staging, target, state) is None
    facts(spark, [(1, 1, "20240101", "A", 9), (99, 1, "20240102", "A", 1)]).write.mode(
        "append"
    ).parquet(staging)
    counts = drain_staging(spark, staging, target, state).first()
    assert (counts.Registros_Insertados, counts.Registros_Existentes) == (1, 1)
    assert read_target(spark, target, FACT).count() == 9


def test_a_drain_keeps_nothing_of_loaded_batches(spark, tmp_path):
    staging, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(11):
        facts(spark, [(i, 1, "20240101", "A", i)]).coalesce(1).write.mode("append").parquet(staging)
        assert drain_staging(spark, staging, target, state).first().Registros_Insertados == 1
        assert not [n for n in os.listdir(f"{state}/rows") if n.startswith("lote=")]
        records = [n for n in os.listdir(f"{state}/loaded/versiones") if n.isdigit()]
        assert len(records) == min(i + 1, KEPT)
    assert drain_staging(spark, staging, target, state) is None
    assert read_target(spark, target, FACT).count() == 11
