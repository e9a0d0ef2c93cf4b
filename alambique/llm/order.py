"""Neighbours and places in a total order, without one sorting task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alambique.operators.joins import lookup_join
from alambique.storage import Measured, materialize, materialize_measured


def with_neighbours(
    df: DataFrame,
    order: Sequence[str],
    carry: Sequence[str],
    label: str,
    circular: bool = False,
) -> DataFrame:
    """Add the structs ``prev`` and ``next``: ``carry`` of the neighbouring rows.

    Rows are dealt out by ranges of ``order`` and stored with the number of
    their range, so every reader sees the same ranges. Neighbours within a range
    come from a window, those across a border from the first and last row of
    each range: one row per range, which is as many as there are tasks. At the
    ends of the table they are NULL or, if ``circular``, the other end. Equal
    rows follow each other in any order; give ``order`` enough columns to tell
    rows apart that differ in ``carry``.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    stored = materialize(ranged, label)
    key = F.struct(*order)
    value = F.struct(*carry)
    ends = stored.groupBy("__range").agg(
        F.min_by(value, key).alias("__first"), F.max_by(value, key).alias("__last")
    )
    ranges = Window.orderBy("__range")
    before, after = F.lag("__last").over(ranges), F.lead("__first").over(ranges)
    if circular:
        whole = ranges.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        before = F.coalesce(before, F.last("__last").over(whole))
        after = F.coalesce(after, F.first("__first").over(whole))
    borders = ends.select(
        "__range", before.alias("__before"), after.alias("__after")
    )
    inside = Window.partitionBy("__range").orderBy(*order)
    return (
        stored.withColumn("prev", F.lag(value).over(inside))
        .withColumn("next", F.lead(value).over(inside))
        .join(F.broadcast(borders), "__range")
        .withColumn("prev", F.coalesce("prev", "__before"))
        .withColumn("next", F.coalesce("next", "__after"))
        .drop("__range", "__before", "__after")
    )


def numbered(rows: DataFrame, order: Sequence[str], label: str) -> Measured:
    """``rows`` with ``at``, their place in their ``grp`` by ``order``, from 0, and
    ``n``, the rows of ``grp``; NULLs come first.

    Rows are dealt out by ranges. A row's place is its place in its range, plus
    the rows of the group in earlier ranges: a table with a row for each range
    and group in it.
    """
    keys = ["grp", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialize(
        ranged.withColumns({"range": F.spark_partition_id(), "nth": F.monotonically_increasing_id()}),
        f"{label}-ranges",
    )
    counts = stored.groupBy("grp", "range").agg(
        F.count(F.lit(1)).alias("rows"), F.min("nth").alias("first")
    )
    whole = Window.partitionBy("grp")
    before = F.sum("rows").over(
        whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select(
        "grp",
        "range",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    placed = lookup_join(stored, starts, ["grp", "range"], "inner")
    return materialize_measured(
        placed.withColumn("at", F.col("nth") + F.col("shift")).drop("range", "nth", "shift"),
        label,
    )
