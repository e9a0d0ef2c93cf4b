import pytest
from pyspark.sql import functions as F

from alambique.functions.draws import PRIME, uniform
from alambique.operators import synth


def share(df, condition):
    return df.agg(F.avg(F.when(condition, 1).otherwise(0))).first()[0]


def test_fault_shares(spark):
    draw = uniform(F.col("id"), 3, 1)
    faults = [(0.02, None), (0.05, F.lit(-1)), (0.01, -F.col("id"))]
    df = spark.range(1, 50_001).withColumn("x", synth.inject(F.col("id"), draw, faults))
    assert share(df, F.col("x").isNull()) == pytest.approx(0.02, abs=0.005)
    assert share(df, F.col("x") == -1) == pytest.approx(0.05, abs=0.005)
    assert share(df, F.col("x") == F.col("id")) == pytest.approx(0.92, abs=0.01)
    assert df.select(synth.inject(F.col("id"), draw, [])).exceptAll(spark.range(1, 50_001)).isEmpty()


def test_draws_do_not_repeat_beyond_the_prime(spark):
    ids = spark.range(1000)
    low, high = uniform(F.col("id"), 3, 1), uniform(F.col("id") + PRIME, 3, 1)
    assert ids.filter(low == high).count() < 5
    other = uniform(F.col("id") + 2 * PRIME, 3, 1)
    assert ids.filter(high == other).count() < 5
    assert ids.agg(F.avg(high)).first()[0] == pytest.approx(0.5, abs=0.05)


def test_a_calendar_counts_its_facts(spark):
    facts = spark.sql("SELECT explode(array('2024-01-01', '2024-01-03', '2024-01-03')) AS d")
    days = synth.calendar(facts, "d").orderBy("Fecha_ID").collect()
    assert [(r.Fecha_ID, r.filas) for r in days] == [
        ("20240101", 1), ("20240102", 0), ("20240103", 2)
    ]
    assert synth.calendar(facts.limit(0), "d").isEmpty()


def test_shuffled_rows(spark):
    df = spark.range(1000)
    first = [r.id for r in synth.shuffle_rows(df, "id", 1).collect()]
    again = [r.id for r in synth.shuffle_rows(df.repartition(7), "id", 1).collect()]
    assert first == again != sorted(first)
    assert sorted(first) == list(range(1000))


def test_append_frames_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    rows = synth.append_frames([a, b, a]).collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (1, "x"), (2, "y")]
