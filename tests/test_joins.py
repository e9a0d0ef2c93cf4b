import pytest
from pyspark.sql import functions as F

from alambique.operators import joins
from alambique.operators.joins import anti_join_unknown, lookup_join, skew_join
from alambique.storage import materialize_measured


@pytest.fixture(scope="module")
def sales(spark):
    """A third of all rows share one key; one key in ten has no product."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    return spark.range(0, 30_000, numPartitions=8).select("id", key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def products(spark):
    keys = spark.range(1000).filter("id % 10 <> 0")
    return keys.select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def uses(df, node):
    df.collect()
    return node in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_strategies_agree(spark, sales, products, how, monkeypatch):
    small = lookup_join(sales, products, "k", how)
    assert uses(small, "BroadcastHashJoin")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(sales, products, "k", how)
        salted = skew_join(sales, products, ["k"], how, hot_rows=1000)
        assert large.columns == small.columns
        assert not uses(large, "BroadcastHashJoin")
        expected = rows(sales.join(products, "k", how).select(*small.columns))
        assert rows(small) == rows(large) == expected
        assert rows(salted.select(*small.columns)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_only_hot_keys_are_salted(spark, sales, products):
    hot = joins.hot_buckets(sales, ["k"], 1 / 4096, 1000)
    bucket = sales.filter("k = 7").select(joins._bucket(["k"])).first()[0]
    assert list(hot) == [bucket] and hot[bucket] >= 10_000
    spread = (
        skew_join(sales, products, ["k"], "left", hot_rows=1000)
        ._jdf.queryExecution()
        .analyzed()
        .toString()
    )
    assert "__salt" in spread


def test_a_hot_key_is_cut_by_its_rows(spark, sales):
    """Ten thousand rows of one key at a thousand a part, evenly."""
    part = F.pmod(F.xxhash64("id", "k", F.lit(joins._SALT)), F.lit(joins._MAX_PARTS)) % 11
    parts = [r["count"] for r in sales.filter("k = 7").groupBy(part).count().collect()]
    assert len(parts) == 11 and max(parts) < 1200


def test_no_other_join_types(sales, products):
    with pytest.raises(ValueError, match="full"):
        skew_join(sales, products, ["k"], "full")


def test_null_keys_are_unknown(spark):
    staged = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    known = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(anti_join_unknown(staged, known, ["k"])) == [(3, "c"), (None, "b")]


def test_measured_size(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k int, v string")
    measured = materialize_measured(df, "test")
    assert (measured.rows, measured.size) == (2, 2 * (16 + 8 + 16) + 3)
    assert rows(measured.df) == rows(df)


def test_measured_size_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, v string")
    measured = materialize_measured(empty, "test")
    assert (measured.rows, measured.size) == (0, 0)
    assert measured.df.count() == 0


def test_wide_sides_are_not_broadcast(spark):
    df = spark.range(3).select("id", F.repeat(F.lit("x"), 100).alias("v"))
    measured = materialize_measured(df, "test")
    assert joins.fits_broadcast(measured)
    assert measured.size > 300


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_tasks_grow_with_the_rows(spark, sales, products, how, monkeypatch):
    """Of four shuffle partitions none would hold less than a quarter of the rows."""
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    for hot_rows in (1_000_000, 1000):
        joined = skew_join(sales, products, ["k"], how, hot_rows=hot_rows)
        expected = sales.join(products, "k", how)
        assert rows(joined) == rows(expected.select(*joined.columns))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count(", 30), REPARTITION_BY_NUM") >= 2 or how == "left_anti"
    monkeypatch.setattr(joins, "TASK_ROWS", 1_000_000)
    few = skew_join(sales, products, ["k"], how)
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
