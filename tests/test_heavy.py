"""Most frequent values by a bounded summary and one exact pass."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from alambique.operators import profile


def brute(values, n):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


def found(spark, values, n, tracked, kind="string"):
    table = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(7)
    return [tuple(r) for r in profile.heavy_values(table, "v", n, tracked).collect()]


@pytest.mark.parametrize("tracked", [64, 1024])
def test_heavy_among_many(spark, tracked):
    draw = random.Random(1)
    values = [f"rare{i}" for i in range(20_000)] + [None] * 50
    for i in range(12):
        values += [f"often{i}"] * (3000 + 100 * (i // 3))  # ties
    draw.shuffle(values)
    assert found(spark, values, 10, tracked) == brute(values, 10)


def test_ties_at_the_end_and_even_values(spark):
    """No value is heavy, so all are counted."""
    values = [i % 3000 for i in range(30_000)]
    assert found(spark, values, 5, 64, "int") == brute(values, 5)
    few = [1, 1, 2, None]
    assert found(spark, few, 5, 64, "int") == brute(few, 5)
    assert found(spark, [None], 5, 64, "int") == [] == found(spark, [], 5, 64, "int")


def test_only_candidates_are_counted(spark):
    table = spark.range(1, 100_001).select(
        F.when(F.col("id") % 2 == 0, F.lit(-7)).otherwise(F.col("id")).alias("v")
    )
    top = profile.heavy_values(table, "v", 1, tracked=64)
    assert [tuple(r) for r in top.collect()] == [(-7, 50_000)]
