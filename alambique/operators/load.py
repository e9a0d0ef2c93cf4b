"""Incremental load of staged rows, with its log and its error detail.

A load inserts the staged rows whose key the target does not have, as one
anti-join. Rows without a complete key match nothing: they are never inserted,
and stay behind in staging.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.functions.rules import CLASSES
from alambique.operators.bloom import prune
from alambique.operators.dedup import keep_one
from alambique.operators.joins import anti_join_unknown, lookup_join, skew_join
from alambique.operators.profile import long_form
from alambique.schemas import LENGTHS, LOAD_STATES, target_schema
from alambique.storage import Measured, materialize, materialize_measured

NEW, EXISTING, KEYLESS = "NUEVO", "EXISTENTE", "SIN_CLAVE"
STATE = "estado_carga"

KEEP_ALL, KEEP_FIRST = "keep_all", "keep_first"


def has_key(keys: Sequence[str]) -> Column:
    """Whether no column of a row's key is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def restrict_target(
    target: DataFrame, staging: DataFrame, column: str
) -> DataFrame:
    """Target rows that share a value of ``column`` with staging.

    With a date as the column, a load shuffles only the days it brings.
    """
    values = staging.select(column).dropna().distinct()
    return lookup_join(target, values, column, "left_semi")


def _stored(staging: DataFrame | Measured) -> Measured:
    """Staged rows, written once if they are not yet."""
    return staging if isinstance(staging, Measured) else materialize_measured(staging, "staged")


def new_rows(
    staging: DataFrame | Measured,
    target: DataFrame,
    keys: Sequence[str],
    policy: str = KEEP_ALL,
    prune_by: str | None = None,
) -> DataFrame:
    """Staged rows to insert; ``keep_first`` takes one row per new key.

    With ``prune_by`` the target is taken to be large, as in ``mark_staging``.
    """
    if policy not in (KEEP_ALL, KEEP_FIRST):
        raise ValueError(f"unknown policy {policy!r}")
    if prune_by:
        staged = _stored(staging)
        near = prune(target, staged, keys)
        new = anti_join_unknown(staged.df.filter(has_key(keys)), near, keys)
    else:
        staging = staging.df if isinstance(staging, Measured) else staging
        keyed = staging.filter(has_key(keys))
        new = lookup_join(keyed, _known(target, keys), list(keys), "left_anti")
    return keep_one(new, keys) if policy == KEEP_FIRST else new


def _known(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.select(*keys).dropna().distinct()


def mark_staging(
    staging: DataFrame | Measured,
    target: DataFrame,
    keys: Sequence[str],
    prune_by: str | None = None,
) -> DataFrame:
    """Staged rows with ``estado_carga``: new, existing or without a key.

    With ``prune_by`` the target is taken to be large: staging is stored once, and
    of the target only the keys that pass a filter of the staged ones are shuffled,
    whatever days they are of. Otherwise the target's keys are measured and
    broadcast if they fit.
    """
    if prune_by:
        staged = _stored(staging)
        staging, target = staged.df, prune(target, staged, keys)
    elif isinstance(staging, Measured):
        staging = staging.df
    known = _known(target, keys).withColumn("__known", F.lit(True))
    join = skew_join if prune_by else lookup_join
    marked = join(staging, known, list(keys), "left")
    state = (
        F.when(~has_key(keys), KEYLESS)
        .when(F.col("__known").isNotNull(), EXISTING)
        .otherwise(NEW)
    )
    return marked.select(*staging.columns, state.alias(STATE))


def existing_rows(
    staging: DataFrame, target: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Staged rows whose key the target already has, counted before the load."""
    known = _known(target, keys)
    return lookup_join(staging, known, list(keys), "left_semi")


def purge_loaded(
    staging: DataFrame | Measured, target: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Staged rows left after a load: those the target does not have."""
    staged = _stored(staging)
    return anti_join_unknown(staged.df, prune(target, staged, keys), keys)


def load_counts(
    marked: DataFrame, keys: Sequence[str], policy: str = KEEP_ALL
) -> DataFrame:
    """One row of counts over the result of ``mark_staging``."""
    n, state = F.col("n"), F.col(STATE)
    new = state == NEW
    if policy == KEEP_FIRST:
        groups = marked.groupBy(*keys, STATE).agg(F.count("*").alias("n"))
        inserted, left_out = F.count_if(new), F.sum(F.when(new, n - 1))
    else:
        groups = marked.groupBy(STATE).agg(F.count("*").alias("n"))
        inserted, left_out = F.sum(F.when(new, n)), F.lit(0)
    counts = {
        "Registros_Procesados": F.sum(n),
        "Registros_Insertados": inserted,
        "Registros_Existentes": F.sum(F.when(state == EXISTING, n)),
        "Registros_Duplicados": left_out,
        "Registros_Errores": F.sum(F.when(state == KEYLESS, n)),
    }
    return groups.agg(
        *[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in counts.items()]
    )


def log_entry(counts: DataFrame, source: str, target: str, note: str) -> DataFrame:
    """A load log row: a warning when rows were left in staging."""
    state = F.when(F.col("Registros_Errores") > 0, "ADVERTENCIA").otherwise("EXITOSO")
    return counts.select(
        F.lit(source).alias("Tabla_Origen"),
        F.lit(target).alias("Tabla_Destino"),
        *[F.col(c) for c in counts.columns],
        state.alias("Estado"),
        F.lit(note).alias("Observaciones"),
    )


# -- Contract -----------------------------------------------------------------

#: Allowed values per column, NULL allowed unless the schema says no.
ALLOWED = {
    "Tipo_Transaccion": CLASSES,
    "Out_Of_Stock_Flag": (0, 1),
    "Estado": LOAD_STATES,
}
DAY = r"^\d{4}-\d{2}-\d{2}$"


def contract_rules(
    df: DataFrame, table: str, allowed: Mapping[str, Sequence] = ALLOWED
) -> dict[str, Column]:
    """Condition that is true for a row breaking the rule, per rule."""
    rules = {}
    for field in target_schema(table):
        value = F.col(field.name)
        if field.name not in df.columns:
            rules[f"{field.name} presente"] = F.lit(True)
            continue
        if not field.nullable:
            rules[f"{field.name} no nulo"] = value.isNull()
        if field.name in LENGTHS:
            longest = LENGTHS[field.name]
            rules[f"{field.name} hasta {longest}"] = F.length(value) > longest
        if field.dataType == T.DateType() and df.schema[field.name].dataType != field.dataType:
            rules[f"{field.name} es fecha"] = ~value.cast("string").rlike(DAY)
    for column, values in allowed.items():
        if column in df.columns and column in target_schema(table).names:
            known = F.col(column).isin(*values)
            rules[f"{column} permitido"] = ~F.coalesce(known, F.lit(True))
    return rules


def contract_violations(
    df: DataFrame, table: str, allowed: Mapping[str, Sequence] = ALLOWED
) -> DataFrame:
    """(regla, filas) for every rule of the target table, in one pass."""
    rules = contract_rules(df, table, allowed)
    return long_form(df, {r: F.count_if(c) for r, c in rules.items()}, "regla", "filas")


# -- Error detail -------------------------------------------------------------


def error_rows(
    df: DataFrame, kind: str, description: Column, sample: Sequence[str]
) -> DataFrame:
    """Rows at fault, cut down to what the error detail shows of them."""
    return df.select(
        F.lit(kind).alias("Tipo_Error"),
        description.alias("Descripcion"),
        *[F.col(c) for c in sample],
    )


def error_detail(
    table: str, errors: Sequence[DataFrame], sample: Sequence[str], n: int = 3
) -> DataFrame:
    """Rows per error with up to ``n`` of them as JSON, smallest first.

    The rows at fault are written once. Their number is combined before the
    shuffle, and the ``n`` samples are picked before it too, so an error that
    hits most of the table is no heavier for one task than a rare one.
    """
    faults = reduce(DataFrame.unionByName, errors)
    faults = materialize(faults, f"errors-{table}")
    group = ["Tipo_Error", "Descripcion"]
    counts = faults.groupBy(*group).agg(F.count("*").alias("Registros_Afectados"))
    order = Window.partitionBy(*group).orderBy(
        *[F.col(c).asc_nulls_last() for c in sample]
    )
    few = faults.withColumn("posicion", F.row_number().over(order)).filter(
        F.col("posicion") <= n
    )
    picked = F.array_sort(F.collect_list(F.struct("posicion", *sample)))
    rows = F.transform(picked, lambda r: F.struct(*[r[c].alias(c) for c in sample]))
    json = F.to_json(rows, {"ignoreNullFields": "false"}).alias("Datos_Ejemplo")
    samples = few.groupBy(*group).agg(json)
    return counts.join(samples, group).select(
        F.lit(table).alias("Tabla"), *group, "Registros_Afectados", "Datos_Ejemplo"
    )
