"""What the plans must and must not contain."""

import re

import pytest

from alambique import storage
from alambique.operators import integrity, joins, profile
from alambique.operators.stats import product_profile
from alambique.plans import cleaning, reports
from alambique.plans.catalog import QUERIES
from alambique.plans.star_views import VIEW_REGIONS, star
from alambique.schemas import FACT
from alambique.session import PROFILE, tune, with_profile
from alambique.storage import materialize


@pytest.fixture(scope="module")
def tables(spark, small_dir):
    """The dirty star as plain tables."""
    return {n: materialize(df, n) for n, df in star(spark, small_dir).items()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join_and_no_copy_of_the_fact(spark, small_dir, name, monkeypatch):
    """Queries may store side tables, staged rows and their output only."""
    stored, write = [], storage.materialize_measured

    def noted(df, label):
        stored.append(label)
        return write(df, label)

    for module in (storage, joins, cleaning):
        monkeypatch.setattr(module, "materialize_measured", noted)
    text = plan(QUERIES[name](spark, small_dir))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    assert FACT not in stored and "classified" not in stored


def test_integrity_is_three_broadcast_semi_joins(spark, tables):
    text = plan(integrity.enforce(tables[FACT], cleaning.clean_all(tables)))
    assert len(re.findall(r"BroadcastHashJoin .*LeftSemi", text)) == 3


def test_clean_fact_is_one_scan_without_a_shuffle(spark, tables):
    fit = cleaning.fit_fact(tables[FACT], cleaning.STRICT)
    text = plan(cleaning.apply_fact(tables[FACT], fit))
    assert "Exchange hashpartitioning" not in text
    assert text.count("ReadSchema: struct<Tienda_ID:int,Producto_ID:int") == 1
    assert "IsNotNull(Ventas_Volumen)" in text  # reaches the scan


def test_price_pass_reads_five_columns(spark, tables):
    text = plan(product_profile(tables[FACT]))
    columns = re.search(r"FileScan parquet \[(.*?)\]", text)[1]
    assert len(columns.split(",")) == 5
    assert "partial_avg" in text


def test_examples_are_limited_before_the_shuffle(spark, tables):
    text = plan(profile.key_examples(tables[FACT]))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_worst_members_are_a_top_k(spark, tables):
    clean = cleaning.clean_all(tables, region_labels=VIEW_REGIONS)
    text = plan(reports.risk_products(clean))
    assert "TakeOrderedAndProject" in text


def test_tune_keeps_what_is_set(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "32m")
    try:
        tune(spark)
        assert spark.conf.get(key) == "32m"
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.unset(key)


def test_profile_names_no_master(spark):
    class Builder(dict):
        def config(self, key, value):
            self[key] = value
            return self

    built = with_profile(Builder(), 64, spark__sql__ansi__enabled="false")
    assert built["spark.sql.shuffle.partitions"] == "64"
    assert built["spark.sql.ansi.enabled"] == "false"
    assert set(PROFILE) < set(built) and "spark.master" not in built
