"""The cube's reports equal those of the facts, before and after each load."""

import pytest
from pyspark.sql import functions as F

from alambique.plans import reports
from alambique.plans.cleaning import clean_all
from alambique.plans.cube import SETS, Cube, cube_rows
from alambique.plans.star_views import VIEW_REGIONS, star
from alambique.schemas import FACT
from alambique.sinks import versions
from alambique.storage import materialize


@pytest.fixture(scope="module")
def clean(spark, small_dir):
    tables = clean_all(star(spark, small_dir), region_labels=VIEW_REGIONS)
    return {n: materialize(df, n) for n, df in tables.items()}


def rows(df):
    return sorted(map(str, df.collect()))


def same(cube, star_):
    assert rows(cube.impact_rate()) == rows(reports.impact_rate(star_))
    assert rows(cube.impact_by_month(star_)) == rows(reports.impact_by_month(star_))
    assert rows(cube.loss_by_cause()) == rows(reports.loss_by_cause(star_))
    assert rows(cube.risk_stores(star_)) == rows(reports.risk_stores(star_))
    assert rows(cube.risk_products(star_, 5)) == rows(reports.risk_products(star_, 5))
    assert rows(cube.risk_map(star_)) == rows(reports.risk_map(star_))


def test_reports_before_and_after_loads(spark, clean, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FANOUT", 2)
    cube, part = Cube(spark, str(tmp_path / "cube")), F.col("Producto_ID") % 3
    cube.add(clean[FACT].filter(part == 0))
    same(cube, {**clean, FACT: clean[FACT].filter(part == 0)})
    pinned = cube.store.latest()
    cube.add(clean[FACT].filter(part == 1))
    same(cube, {**clean, FACT: clean[FACT].filter(part != 2)})
    cube.tidy()
    cube.add(clean[FACT].filter(part == 2))
    same(cube, clean)
    cube.tidy()
    same(cube, clean)
    old = cube.sums("clase", pinned).agg(F.sum("transacciones")).first()[0]
    assert old == clean[FACT].filter(part == 0).count()


def test_an_empty_cube(spark, clean, tmp_path):
    cube = Cube(spark, str(tmp_path / "cube"))
    same(cube, {**clean, FACT: clean[FACT].limit(0)})


def test_a_load_that_dies_adds_nothing(spark, clean, tmp_path, monkeypatch):
    cube = Cube(spark, str(tmp_path / "cube"))
    cube.add(clean[FACT])
    with monkeypatch.context() as patch:
        patch.setattr(cube.store, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            cube.add(clean[FACT])
    same(cube, clean)


def test_one_pass_over_the_facts(spark, clean, tmp_path):
    text = cube_rows(clean[FACT])._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert "Exchange" in text and text.count("HashAggregate") >= 2  # combined before the shuffle
    cube = Cube(spark, str(tmp_path / "cube"))
    cube.add(clean[FACT])
    # A report opens the folder of its own set.
    files = cube.sums("clase").inputFiles()
    assert files and len(SETS) == 5
    plan = cube.sums("clase")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(conjunto" in plan
