"""Load staged tables into their targets, with a log and an error detail."""

from __future__ import annotations

import getpass
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.operators.dedup import duplicate_keys, keep_one
from alambique.operators.integrity import orphans
from alambique.operators.load import (
    KEEP_ALL,
    KEEP_FIRST,
    KEYLESS,
    NEW,
    STATE,
    error_detail,
    error_rows,
    load_counts,
    log_entry,
    mark_staging,
)
from alambique.plans.cleaning import conform
from alambique.schemas import (
    DIMENSIONS,
    ERROR_DETAIL,
    FACT,
    FACT_KEY,
    KEYS,
    LOAD_LOG,
    TARGET_NAMES,
    target_schema,
)
from alambique.storage import delete, materialize, materialize_measured

#: Column whose staged values limit how much of a target is read.
PRUNE_BY = {FACT: "Fecha_ID"}

#: Folder of a target that holds one month, from the column above.
MONTH = "Mes_Carga"

#: Most months that are named one by one in a read of the target.
MONTHS = 4096


def load_key(table: str) -> tuple[str, ...]:
    return FACT_KEY if table == FACT else (KEYS[table],)


def month_of(column: str) -> Column:
    return F.coalesce(F.substring(column, 1, 6), F.lit("")).alias(MONTH)


def read_target(
    spark: SparkSession, path: str, table: str, months: Sequence[str] | None = None
) -> DataFrame:
    """The target table, empty before its first load; only some months if given.

    The months are folders, so no file of another one is opened.
    """
    schema = stored = target_schema(table)
    if table in PRUNE_BY:
        stored = T.StructType([*schema, T.StructField(MONTH, T.StringType())])
    try:
        found = spark.read.schema(stored).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if months is not None and table in PRUNE_BY:
        found = found.filter(F.col(MONTH).isin(list(months)))
    return found.select(*schema.names)


def staged_months(staging: DataFrame, table: str) -> list[str] | None:
    """Months that staged rows fall in; None if there are too many to name."""
    if table not in PRUNE_BY:
        return None
    months = staging.select(month_of(PRUNE_BY[table])).distinct()
    found = [row[0] for row in months.limit(MONTHS + 1).collect()]
    return found if len(found) <= MONTHS else None


def insert_marked(marked: DataFrame, table: str, path: str, policy: str) -> None:
    """Append the rows marked as new; running it again would insert none."""
    new = marked.filter(F.col(STATE) == NEW).drop(STATE)
    if policy == KEEP_FIRST:
        new = keep_one(new, load_key(table))
    rows = conform(new, table)
    if table not in PRUNE_BY:
        rows.write.mode("append").parquet(path)
        return
    dated = rows.select("*", month_of(PRUNE_BY[table])).hint("rebalance", F.col(MONTH))
    dated.write.mode("append").partitionBy(MONTH).parquet(path)


def load_table_into(
    staging: DataFrame, table: str, target_path: str, policy: str = KEEP_ALL
) -> tuple[DataFrame, DataFrame]:
    """Insert a table's new rows; returns its marked staging and its counts.

    Staging is read once and meets the target once: the marked rows are written,
    and the insert, the counts, the errors and the remainder all read them.
    """
    spark, keys = staging.sparkSession, load_key(table)
    staged = materialize_measured(staging, f"staged-{table}")
    target = read_target(spark, target_path, table, staged_months(staged.df, table))
    marked = mark_staging(staged, target, keys, PRUNE_BY.get(table))
    marked = materialize(marked, f"marked-{table}")
    insert_marked(marked, table, target_path, policy)
    return marked, load_counts(marked, keys, policy)


def _errors(
    marked: DataFrame, table: str, target_paths: Mapping[str, str]
) -> DataFrame:
    """What is wrong with staged rows: no key, a repeated key, no dimension."""
    spark, keys = marked.sparkSession, list(load_key(table))
    rows = marked.drop(STATE)
    keyless = marked.filter(F.col(STATE) == KEYLESS)
    found = [
        error_rows(keyless, "VALIDACION", F.lit("sin clave"), keys),
        error_rows(
            duplicate_keys(rows.dropna(subset=keys), keys),
            "DUPLICADO", F.lit("clave repetida"), keys,
        ),
    ]
    if table == FACT and all(d in target_paths for d in DIMENSIONS):
        dims = {d: read_target(spark, target_paths[d], d) for d in DIMENSIONS}
        missing = F.concat(F.col("clave_huerfana"), F.lit(" sin dimensión"))
        found.append(error_rows(orphans(rows, dims), "INTEGRIDAD", missing, keys))
    return error_detail(f"clean_{table}", found, keys)


def _append(rows: DataFrame, ddl: str, path: str, **values) -> None:
    """Append rows of the given columns to a table of audit records."""
    typed = []
    for field in T.StructType.fromDDL(ddl):
        given = values.get(field.name)
        known = F.col(field.name) if field.name in rows.columns else F.lit(given)
        typed.append(known.cast(field.dataType).alias(field.name))
    rows.select(*typed).write.mode("append").parquet(path)


def _leave_rest(
    staging: DataFrame, marked: DataFrame, path: str, files: Iterable[str]
) -> None:
    """Leave the rows without a key in staging, in place of the files read.

    Files that arrived since are not touched. Between the two steps those rows
    are there twice; they are never loaded.
    """
    rest = marked.filter(F.col(STATE) == KEYLESS).drop(STATE)
    rest.write.mode("append").parquet(path)
    for name in files:
        delete(staging.sparkSession, name)


def run_load(
    staging: Mapping[str, DataFrame],
    target_paths: Mapping[str, str],
    log_path: str,
    staging_paths: Mapping[str, str] | None = None,
    order: Sequence[str] = tuple(TARGET_NAMES),
    policy: str = KEEP_ALL,
    detail_path: str | None = None,
) -> DataFrame:
    """Load every staged table in order; returns this run's rows of the load log.

    A table's log row and error details are appended when it ends. One that
    fails leaves the state ERROR with its message and a SISTEMA detail, and ends
    the run with its error. Details go beside the log unless a path is given.
    With ``staging_paths`` the files read are replaced by the rows left over,
    those without a key, once their table is loaded; ``staging`` must then read
    those folders.
    """
    run, spark = str(uuid.uuid4()), next(iter(staging.values())).sparkSession
    detail_path = detail_path or f"{log_path.rstrip('/')}_errores"
    for table in [t for t in order if t in staging]:
        started, clock = datetime.now(timezone.utc), time.monotonic()

        def finished(**values) -> dict:
            return {
                "Ejecucion_ID": run,
                "Duracion_Segundos": time.monotonic() - clock,
                "Usuario": getpass.getuser(),
                "Fecha_Inicio": started,
                "Fecha_Fin": datetime.now(timezone.utc),
                "Fecha_Error": datetime.now(timezone.utc),
                **values,
            }

        try:
            read = staging_paths and table in staging_paths
            files = staging[table].inputFiles() if read else []
            marked, counts = load_table_into(
                staging[table], table, target_paths[table], policy
            )
            _append(_errors(marked, table, target_paths), ERROR_DETAIL, detail_path, **finished())
            if read:
                _leave_rest(staging[table], marked, staging_paths[table], files)
            entry = log_entry(counts, f"clean_{table}", TARGET_NAMES[table], policy)
            _append(entry, LOAD_LOG, log_path, **finished())
        except Exception as error:
            failed = finished(
                Tabla=f"clean_{table}",
                Tabla_Origen=f"clean_{table}",
                Tabla_Destino=TARGET_NAMES[table],
                Estado="ERROR",
                Mensaje=str(error),
                Observaciones=policy,
                Tipo_Error="SISTEMA",
                Descripcion=str(error),
            )
            one = spark.range(1).drop("id")
            _append(one, LOAD_LOG, log_path, **failed)
            _append(one, ERROR_DETAIL, detail_path, **failed)
            raise
    schema = T.StructType.fromDDL(LOAD_LOG)
    return spark.read.schema(schema).parquet(log_path).filter(F.col("Ejecucion_ID") == run)
