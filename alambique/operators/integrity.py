"""Referential integrity of the fact table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alambique.operators.joins import lookup_join
from alambique.schemas import DATE_DIM, KEYS, PRODUCT_DIM, STORE_DIM
from alambique.storage import Measured, materialize_all

#: Order in which the foreign keys are checked; the first to fail is reported.
CHECK_ORDER = (DATE_DIM, STORE_DIM, PRODUCT_DIM)


def _dimension_keys(
    dims: Mapping[str, DataFrame], marker: str | None = None
) -> dict[str, Measured]:
    """Distinct keys of each dimension, written once, with an optional marker."""
    keys = {}
    for table in CHECK_ORDER:
        keys[table] = dims[table].select(KEYS[table]).dropna().distinct()
        if marker:
            keys[table] = keys[table].withColumn(marker + table, F.lit(True))
    return materialize_all(keys)


def enforce(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facts whose date, store and product exist."""
    for table, keys in _dimension_keys(dims).items():
        fact = lookup_join(fact, keys, KEYS[table], "left_semi")
    return fact


def first_missing(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facts with ``clave_huerfana``: the first key not found, else NULL."""
    checks, marker = [], "__"
    for table, keys in _dimension_keys(dims, marker).items():
        fact = lookup_join(fact, keys, KEYS[table])
        checks.append(F.when(F.col(marker + table).isNull(), KEYS[table]))
    helpers = [marker + table for table in CHECK_ORDER]
    return fact.withColumn("clave_huerfana", F.coalesce(*checks)).drop(*helpers)


def orphans(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facts with a key that no dimension has, marked with that key's column."""
    return first_missing(fact, dims).filter(F.col("clave_huerfana").isNotNull())


def orphan_counts(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facts removed per foreign key, in order of checking, and in all."""
    marked = first_missing(fact, dims)
    missing = F.col("clave_huerfana")
    removed = [(KEYS[t], F.count_if(missing == KEYS[t])) for t in CHECK_ORDER]
    removed.append(("total", F.count(missing)))
    one_row = marked.agg(*[c.alias(k) for k, c in removed])
    rows = [
        F.struct(F.lit(k).alias("clave"), F.col(k).alias("huerfanos"))
        for k, _ in removed
    ]
    return one_row.select(F.inline(F.array(*rows)))
