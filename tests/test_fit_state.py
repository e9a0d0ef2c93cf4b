"""States of months give the fit of all facts, whatever months were replaced."""

import pytest
from pyspark.sql import functions as F

from alambique.operators import profile, stats
from alambique.operators.quantiles import exact_quantiles
from alambique.plans.fit_state import RANK_ERROR, FitState, rank_errors
from alambique.plans.star_views import view
from alambique.schemas import FACT
from alambique.storage import materialize

MONTH = "coalesce(substring(Fecha_ID, 1, 6), '')"


@pytest.fixture(scope="module")
def fact(spark, small_dir):
    return materialize(view(spark, small_dir, FACT), "facts")


def same(state, fact):
    full = stats.outlier_bounds(fact, "Ventas_Volumen", 3.0)
    assert state.bounds(3.0) == pytest.approx(tuple(full), abs=1e-9)
    prices = {r[0]: r[1] for r in stats.average_prices(fact).collect()}
    assert {r[0]: r[1] for r in state.average_prices().collect()} == pytest.approx(prices)
    priced = fact.filter(F.col("Precio") > 0)
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    errors = rank_errors(priced, "Precio", state.price_quantiles(shares)).collect()
    assert len(errors) == 5 and all(r.error <= RANK_ERROR for r in errors)


def test_adding_replacing_and_emptying_months(spark, fact, tmp_path):
    state = FitState(spark, str(tmp_path / "state"))
    early = fact.filter(f"{MONTH} < '1995'")
    state.update(early)
    same(state, early)
    pinned = state.store.latest()
    state.update(fact.filter(f"{MONTH} >= '1995'"))
    same(state, fact)
    changed = fact.withColumn(
        "Ventas_Volumen", F.when(F.expr(f"{MONTH} = '199603'"), F.col("Ventas_Volumen") * 7).otherwise(F.col("Ventas_Volumen"))
    ).filter(f"{MONTH} <> '199604'")
    state.update(changed.filter(f"{MONTH} = '199603'"), months=["199604"])
    same(state, changed)
    assert state.bounds(3.0, pinned) == pytest.approx(tuple(stats.outlier_bounds(early, "Ventas_Volumen")))


def test_only_the_months_given_are_read(spark, fact, tmp_path):
    state = FitState(spark, str(tmp_path / "state"))
    state.update(fact)
    read = state.bounds_frame(3.0).inputFiles()
    assert read and not set(read) & set(fact.inputFiles())
    assert not set(state.average_prices().inputFiles()) & set(fact.inputFiles())


def test_no_facts(spark, fact, tmp_path):
    state = FitState(spark, str(tmp_path / "state"))
    state.update(fact.limit(0))
    assert state.bounds(3.0) == (None, None, None, None)
    assert state.average_prices().isEmpty()
    assert [r.valor for r in state.price_quantiles([0.5]).collect()] in ([None], [])


def test_rank_error_of_exact_quantiles(fact):
    found = exact_quantiles(fact, "Precio", [0.25, 0.5]).values
    frame = fact.sparkSession.createDataFrame(list(found.items()), "cuantil double, valor double")
    assert all(r.error == 0 for r in rank_errors(fact, "Precio", frame).collect())


def test_distinct_counts_are_one_pass(spark, fact):
    columns = ["Tienda_ID", "Producto_ID", "Fecha_ID", "Precio"]
    sketches = profile.distinct_sketches(fact, *columns)
    text = sketches._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and text.count("FileScan") == 1
    exact = {r.columna: r.distintos for r in profile.distinct_counts(fact, *columns).collect()}
    parts = [fact.filter(F.coalesce(F.col("Producto_ID") % 3, F.lit(0)) == i) for i in range(3)]
    union = profile.distinct_sketches(parts[0], *columns)
    for part in parts[1:]:
        union = union.union(profile.distinct_sketches(part, *columns))
    for found in (sketches, profile.merged_sketches(union, *columns)):
        near = {r.columna: r.distintos for r in profile.sketched_counts(found, *columns).collect()}
        assert near == pytest.approx(exact, rel=profile.SKETCH_ERROR)
    none = profile.sketched_counts(profile.distinct_sketches(fact.limit(0), *columns), *columns)
    assert {r.distintos for r in none.collect()} == {0}
