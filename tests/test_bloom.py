"""The filter of staged keys that a load tests where it reads its target."""

import re

import pytest
from pyspark.sql import functions as F

from alambique.operators import bloom, load
from alambique.schemas import FACT_KEY
from alambique.storage import materialize, materialize_measured

KEYS = ("a", "b")


def keys(spark, low, high):
    return spark.range(low, high).select(
        (F.col("id") % 1000).cast("int").alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b")
    )


@pytest.mark.parametrize("n", [1, 100, 20_000])
def test_keeps_all_matches_and_few_others(spark, n):
    staged = materialize_measured(keys(spark, 0, n), "staged")
    target = keys(spark, 0, 200_000).withColumn("v", F.col("a") * 2)
    passed = bloom.key_filter(staged, target, KEYS).might_match(target)
    assert passed.columns == target.columns
    found = {r.b for r in passed.collect()}
    assert {f"k{i}" for i in range(n)} <= found
    assert len(found) - n <= bloom.FALSE_POSITIVES * (200_000 - n)


def test_types_and_nulls(spark):
    staged = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    target = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a long, b string")
    passed = bloom.prune(target, materialize_measured(staged, "staged"), KEYS)
    assert [tuple(r) for r in passed.collect()] == [(1, "x")]
    assert passed.schema == target.schema
    none = materialize_measured(staged.limit(0), "staged")
    assert bloom.prune(target, none, KEYS).isEmpty()


def test_beyond_its_size_nothing_is_filtered(spark, monkeypatch):
    monkeypatch.setattr(bloom, "BROADCAST_BYTES", 1000)
    staged = materialize_measured(keys(spark, 0, 10), "staged")
    assert bloom.key_filter(staged, keys(spark, 0, 5), KEYS) is None
    assert bloom.prune(keys(spark, 0, 50), staged, KEYS).count() == 50


def _facts(spark, low, high):
    """Keys spread over 24 months."""
    n = F.col("id")
    day = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (n % 730).cast("int")), "yyyyMMdd")
    return spark.range(low, high).select(
        n.cast("int").alias("Producto_ID"), (n % 50).cast("int").alias("Tienda_ID"),
        day.alias("Fecha_ID"), F.lit("VENTA_NORMAL").alias("Tipo_Transaccion"),
    )


def test_a_load_shuffles_matches_and_few_others(spark):
    """Staging touches every month; the target's other rows stay where they are."""
    staging = materialize(_facts(spark, 0, 5_000), "staging")
    target = materialize(_facts(spark, 4_000, 150_000), "target")
    marked = load.mark_staging(staging, target, FACT_KEY, prune_by="Fecha_ID")
    text = marked._jdf.queryExecution().executedPlan().toString()
    # The scan of the target meets the filter below the exchange of its keys.
    assert re.search(r"Exchange hashpartitioning.*BroadcastHashJoin \[__bucket.*FileScan", text, re.S)
    marked.collect()
    plan = marked._jdf.queryExecution().executedPlan()
    shuffled = _rows_shuffled(plan)
    assert 1_000 <= min(shuffled) <= 1_000 + bloom.FALSE_POSITIVES * 145_000
    counts = {r[load.STATE]: r["count"] for r in marked.groupBy(load.STATE).count().collect()}
    assert counts == {load.NEW: 4_000, load.EXISTING: 1_000}


def _rows_shuffled(plan) -> list[int]:
    """Rows each exchange of a plan that ran has written."""
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            nodes.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found
