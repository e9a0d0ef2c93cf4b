import math
import random

import pytest
from pyspark.sql import functions as F

from alambique.operators.quantiles import approx_quantile, exact_quantile, exact_quantiles

RNG = random.Random(5)
CASES = {
    "cents": [round(RNG.uniform(0.5, 5.5), 2) for _ in range(999)],
    "wide": [RNG.choice([-1, 1]) * 10 ** RNG.uniform(-9, 12) for _ in range(1000)],
    "close": [1.0 + i * 2.0**-52 for i in range(500)],
    "hot": [3.0] * 600 + [RNG.random() for _ in range(900)],
    "negative": [-float(i) for i in range(100)],
    "signed zero": [0.0, -0.0, 0.0],
    "huge": [1.0, 1e301, 1e302, 1.7e308, -1.7e308],
    "one": [42.5],
    "two": [1.0, 2.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.75, 1.0])
def test_exact(spark, name, q):
    values = sorted(CASES[name])
    rank = max(1, math.ceil(q * len(values)))
    df = spark.createDataFrame([(v,) for v in CASES[name]], "x double")
    assert exact_quantile(df, "x", q) == values[rank - 1]


def test_skips_null_and_what_is_not_finite(spark):
    odd = [(None,), (float("nan"),), (float("inf"),), (1.0,), (2.0,), (3.0,)]
    assert exact_quantile(spark.createDataFrame(odd, "x double"), "x") == 2.0


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(df, "x") is None
    assert approx_quantile(df, "x") is None


def test_approximate_rank(spark):
    df = spark.range(100_001).select(F.col("id").cast("double").alias("x"))
    assert abs(approx_quantile(df, "x") - 50_000) <= 10
    assert exact_quantile(df, "x") == 50_000


def test_many_shares_in_one_search(spark):
    rng = random.Random(7)
    values = [round(rng.gauss(0, 3000), 2) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], "x double")
    shares = (0.01, 0.25, 0.5, 0.75, 0.99)
    found = exact_quantiles(df, "x", shares)
    ranked = sorted(values)
    assert found.values == {q: ranked[max(1, math.ceil(q * 5000)) - 1] for q in shares}
    assert found.rows == 5002 and found.passes <= 3


def test_rows_are_counted_without_values(spark):
    found = exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5])
    assert found.values == {0.5: None} and found.rows == 1
    empty = exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5])
    assert empty.values == {0.5: None} and empty.rows == 0
