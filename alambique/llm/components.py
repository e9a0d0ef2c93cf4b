"""Connected components of a graph of any size, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alambique.operators.joins import lookup_join
from alambique.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected to.

    ``links`` has node numbers ``a`` and ``b``. Rounds hang the larger
    neighbours of each node below its smallest one, then the smaller ones,
    until nothing changes; each round is stored. The number of rounds grows with
    the logarithm of the longest path. Only counts reach the driver.
    """
    edges = materialize(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("label"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("label"), F.col("node")))
        large = _hung(both).filter(F.col("node") > F.col("at"))
        stars = materialize(large.select("node", "label").distinct(), "large-star")
        small = _hung(stars, keep_center=True)
        edges = materialize(
            small.filter(F.col("node") != F.col("label")).select("node", "label").distinct(),
            "small-star",
        )
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("node", "label").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state == before:
            return edges
        before = state


def _hung(edges: DataFrame, keep_center: bool = False) -> DataFrame:
    """Each neighbour ``node`` of a center ``at`` with the least of both's
    neighbourhood as ``label``; the center itself too if asked for."""
    sides = edges.select(F.col("node").alias("at"), F.col("label").alias("near"))
    least = sides.groupBy("at").agg(F.least(F.min("near"), F.first("at")).alias("label"))
    found = lookup_join(sides, least, "at", "inner").select(
        F.col("near").alias("node"), "at", "label"
    )
    if keep_center:
        found = found.union(least.select(F.col("at").alias("node"), "at", "label"))
    return found
