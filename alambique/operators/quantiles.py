"""Exact quantiles of a column without gathering it anywhere.

Each pass cuts the value ranges still open into buckets by functions that never
decrease, counts them, and keeps the bucket of each wanted rank. All quantiles
share a pass. It moves a row a quantile to the driver and at most 1.5 million
bucket counts, and 65,536 more a quantile, through a shuffle, however large the
table and however common a value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LINEAR = 1 << 16
_PER_UNIT = 1000  # first pass: buckets about 0.1 % wide, at most 1.5 million


@dataclass(frozen=True)
class Quantiles:
    """``values`` by share; ``rows`` of the column, NULL and all included."""

    values: dict[float, float | None]
    rows: int
    passes: int


def exact_quantile(df: DataFrame, column: str, q: float = 0.5) -> float | None:
    """Smallest value whose cumulative share reaches ``q``; see below."""
    return exact_quantiles(df, column, [q]).values[q]


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> Quantiles:
    """For each share the smallest value whose cumulative share reaches it.

    NULL, NaN and the infinities are skipped; no value gives None. The first
    pass, which also counts the rows, finds a bucket about 0.1 % wide for each
    share; a few more narrow the buckets that hold several values, all at once.
    """
    x = F.col("x")
    column = F.col(column).cast("double")
    finite = column.isNotNull() & ~F.isnan(column) & (F.abs(column) != float("inf"))
    every = df.select(F.when(finite, column).alias("x"))
    # log1p(|x| * 1e6), in a form that does not overflow.
    tiny = F.log1p(F.abs(x) * 1e6)
    huge = F.log(F.abs(x)) + math.log(1e6)
    magnitude = F.when(F.abs(x) < 1e6, tiny).otherwise(huge) * _PER_UNIT
    counts = _counted(every, F.floor(F.signum(x) * magnitude))
    total = F.sum("n").over(Window.partitionBy())
    known = F.sum(F.when(F.col("low").isNotNull(), F.col("n"))).over(Window.partitionBy())
    running = Window.orderBy(F.col("bucket").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    wanted = F.array(*[F.lit(float(q)) for q in shares])
    summed = counts.select(
        "low", "high", "n", F.sum("n").over(running).alias("seen"), total.alias("rows"),
        known.alias("known"),
    )
    ranked = summed.select("*", F.explode(wanted).alias("q"))
    rank = F.greatest(F.ceil(F.col("known") * F.col("q")), F.lit(1))
    start = F.col("seen") - F.col("n")
    found = (
        ranked.withColumn("k", rank)
        .filter(F.col("k").between(start + 1, F.col("seen")) | F.col("low").isNull())
        .select("q", "low", "high", (F.col("k") - start).alias("k"), "rows")
        .collect()
    )
    rows = found[0].rows if found else 0
    open_ = {r.q: (r.low, r.high, r.k) for r in found if r.low is not None}
    passes = 1
    while any(low < high for low, high, _ in open_.values()):
        open_ |= _narrowed(every, {q: r for q, r in open_.items() if r[0] < r[1]})
        passes += 1
    values = {q: open_[float(q)][0] if float(q) in open_ else None for q in shares}
    return Quantiles(values, rows, passes)


def _narrowed(values: DataFrame, ranges: dict[float, tuple]) -> dict[float, tuple]:
    """One pass that cuts each open range into buckets and keeps the wanted one."""
    x = F.col("x")
    # Halves keep a range of opposite signs from overflowing.
    parts = [
        F.when(
            x.between(low, high),
            F.struct(
                F.lit(q).alias("part"),
                F.floor(
                    (x / 2 - low / 2) / F.lit(high / 2 - low / 2) * _LINEAR
                ).alias("bucket"),
                F.lit(rank).alias("k"),
            ),
        )
        for q, (low, high, rank) in ranges.items()
    ]
    lows, highs = zip(*[(low, high) for low, high, _ in ranges.values()])
    inside = values.filter(x.between(min(lows), max(highs)))
    tagged = inside.select("x", F.explode(F.array_compact(F.array(*parts))).alias("p"))
    counts = tagged.groupBy("p.part", "p.bucket", "p.k").agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    running = (
        Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    start = F.col("seen") - F.col("n")
    kept = (
        counts.withColumn("seen", F.sum("n").over(running))
        .filter(F.col("k").between(start + 1, F.col("seen")))
        .select("part", "low", "high", (F.col("k") - start).alias("k"))
    )
    return {r.part: (r.low, r.high, r.k) for r in kept.collect()}


def _counted(values: DataFrame, bucket: Column) -> DataFrame:
    return values.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )


def approx_quantile(
    df: DataFrame, column: str, q: float = 0.5, accuracy: int = 10_000
) -> float | None:
    """One-pass quantile whose rank is off by at most 1/accuracy."""
    return df.agg(F.percentile_approx(column, q, accuracy)).first()[0]
