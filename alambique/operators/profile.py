"""Profiling: statistics, NULLs, key patterns, values and business scenarios.

Every function but ``heavy_values`` is one pass over its table, with results as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.functions.dates import key_class
from alambique.operators.joins import lookup_join
from alambique.storage import materialize, materialize_measured


def long_form(df: DataFrame, values: dict[str, Column], name: str, value: str):
    """Turn the columns of a one-row aggregate into (name, value) rows."""
    one_row = df.agg(*[c.alias(k) for k, c in values.items()])
    pairs = [
        F.struct(F.lit(k).alias(name), F.col(f"`{k}`").alias(value)) for k in values
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, stddev, minimum and maximum of the given or all columns."""
    chosen = list(columns) or df.columns
    fields = {f.name: f.dataType for f in df.schema}
    aggregates, rows = [], []
    for c in chosen:
        text = isinstance(fields[c], T.StringType)
        number = F.col(c).try_cast("double") if text else F.col(c).cast("double")
        aggregates += [
            F.count(c).alias(f"{c}__n"),
            F.mean(number).alias(f"{c}__mean"),
            F.stddev_samp(number).alias(f"{c}__stddev"),
            F.min(F.col(c) if text else number).alias(f"{c}__min"),
            F.max(F.col(c) if text else number).alias(f"{c}__max"),
        ]
        none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("double")
        low, high = F.col(f"{c}__min"), F.col(f"{c}__max")
        rows.append(
            F.struct(
                F.lit(c).alias("columna"),
                F.col(f"{c}__n").alias("n"),
                F.col(f"{c}__mean").alias("media"),
                F.col(f"{c}__stddev").alias("desviacion"),
                (none_number if text else low).alias("minimo"),
                (none_number if text else high).alias("maximo"),
                (low if text else none_text).alias("minimo_texto"),
                (high if text else none_text).alias("maximo_texto"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULLs per column."""
    nulls = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return long_form(df, nulls, "columna", "nulos")


def key_patterns(df: DataFrame, key: str = "Fecha_ID") -> DataFrame:
    """Rows per pattern class of a key, most frequent first."""
    return frequencies(df.select(key_class(F.col(key)).alias("clase")), "clase")


def key_examples(df: DataFrame, key: str = "Fecha_ID", n: int = 5) -> DataFrame:
    """Up to ``n`` rows per pattern class, smallest keys first.

    The rank filter runs before the shuffle too, so a class of any size sends
    at most ``n`` rows per task.
    """
    classed = df.select(key_class(F.col(key)).alias("clase"), F.col(key))
    order = Window.partitionBy("clase").orderBy(F.col(key).asc_nulls_last())
    ranked = classed.withColumn("posicion", F.row_number().over(order))
    return ranked.filter(F.col("posicion") <= n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Number of distinct values per column, NULL counted as one."""
    counts = {
        c: F.count_distinct(F.col(c))
        + F.max(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long")
        for c in columns
    }
    return long_form(df, counts, "columna", "distintos")


#: Bits of the row number of a distinct-count sketch, and how far it may be off.
SKETCH_BITS, SKETCH_ERROR = 14, 0.03


def distinct_sketches(df: DataFrame, *columns: str) -> DataFrame:
    """One row: for each column a sketch of its distinct values, and whether it has
    a NULL. Rows are read once and not multiplied; sketches of parts can be merged."""
    found = []
    for c in columns:
        found += [
            F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(c),
            F.max(F.col(c).isNull()).alias(f"{c}__nulo"),
        ]
    return df.agg(*found)


def merged_sketches(parts: DataFrame, *columns: str) -> DataFrame:
    """One row from the rows of several parts."""
    found = []
    for c in columns:
        found += [F.hll_union_agg(c).alias(c), F.max(f"{c}__nulo").alias(f"{c}__nulo")]
    return parts.agg(*found)


def sketched_counts(sketches: DataFrame, *columns: str) -> DataFrame:
    """Number of distinct values per column, NULL counted as one, off by
    SKETCH_ERROR at most in all but rare cases."""
    counts = [
        F.struct(
            F.lit(c).alias("columna"),
            (
                F.coalesce(F.hll_sketch_estimate(c), F.lit(0))
                + F.coalesce(F.col(f"{c}__nulo"), F.lit(False)).cast("long")
            ).alias("distintos"),
        )
        for c in columns
    ]
    return sketches.select(F.inline(F.array(*counts)))


def frequencies(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first or in order of the values."""
    counts = df.groupBy(column).agg(F.count("*").alias("filas"))
    value = F.col(column).asc_nulls_last()
    return counts.orderBy(*([value] if by_value else [F.desc("filas"), value]))


#: Values that the summary of heavy values tracks; one of more than ERROR / TRACKED of
#: all rows is always among them.
TRACKED, TRACK_ERROR = 1 << 16, 3.5


def heavy_values(df: DataFrame, column: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """The ``n`` most frequent values with their exact counts, ties in order of the
    values, NULL left out; for columns of very many values.

    A summary of counters, of bounded size in each task and merged, gives the
    candidates, and a second pass counts only those. If the last of the ``n`` is too
    rare for the summary to be sure of it, every value is counted instead.
    """
    order = [F.desc("filas"), F.col(column)]
    known = df.select(column).filter(F.col(column).isNotNull())
    summary = F.expr(f"approx_top_k(`{column}`, {tracked}, {tracked})")
    summed = known.agg(F.count(F.lit(1)).alias("rows"), summary.alias("items"))
    found = materialize(summed, "summary")
    rows = found.first().rows
    candidates = materialize_measured(
        found.select(F.explode("items").alias("item")).select(F.col("item.item").alias(column)),
        "candidates",
    )
    counts = lookup_join(known, candidates, column, "inner").groupBy(column).agg(
        F.count(F.lit(1)).alias("filas")
    )
    counts = materialize(counts, "candidate-counts")
    top = counts.orderBy(*order).limit(n)
    last = top.agg(F.count(F.lit(1)).alias("n"), F.min("filas").alias("filas")).first()
    covered = counts.agg(F.coalesce(F.sum("filas"), F.lit(0))).first()[0]
    sure = last.n == n and last.filas * tracked > TRACK_ERROR * rows
    if not sure and covered < rows:
        every = known.groupBy(column).agg(F.count(F.lit(1)).alias("filas"))
        return every.orderBy(*order).limit(n)
    return top.select(column, "filas").orderBy(*order)


def scenarios() -> dict[str, Column]:
    """Business scenarios of a raw sales row. They overlap: see ``scenario_shares``.

    The two ``_ref`` forms take every row without a value, because their OR
    binds weaker than the conditions before it; the plain forms do not.
    """
    v, p = F.col("Ventas_Volumen"), F.col("Precio")
    w, o = F.col("Ventas_Valor"), F.col("Out_Of_Stock_Flag")
    no_value = w.isNull()
    return {
        "venta_normal": (w > 0) & (v > 0) & (p > 0) & (o == 0),
        "devolucion": (v < 0) & (p > 0),
        "ajuste_inventario": (v < 0) & (p > 0) & (o == 1),
        "venta_perdida_ref": ((v == 0) & (o == 1) & (w == 0)) | no_value,
        "registro_sin_venta_ref": ((v == 0) & (o == 0) & (w == 0)) | no_value,
        "venta_perdida": (v == 0) & (o == 1) & ((w == 0) | no_value),
        "registro_sin_venta": (v == 0) & (o == 0) & ((w == 0) | no_value),
    }


#: Scenarios whose shares add up to the printed total.
TOTAL_OF = (
    "venta_normal",
    "devolucion",
    "ajuste_inventario",
    "venta_perdida_ref",
    "registro_sin_venta_ref",
)


def scenario_shares(df: DataFrame, total_of: Sequence[str] = TOTAL_OF) -> DataFrame:
    """Rows and share of rows per scenario, and their total, in one pass.

    Adjustments are also returns, so the total is not a share of the table.
    """
    counts = {name: F.count_if(rule) for name, rule in scenarios().items()}
    counts["total"] = sum((counts[name] for name in total_of), F.lit(0))
    one_row = df.agg(
        F.count("*").alias("__all"), *[c.alias(k) for k, c in counts.items()]
    )
    pairs = [
        F.struct(
            F.lit(k).alias("escenario"),
            F.col(k).cast("long").alias("filas"),
            F.try_divide(F.col(k), F.col("__all")).alias("proporcion"),
        )
        for k in counts
    ]
    return one_row.select(F.inline(F.array(*pairs)))
