"""Writing tables to files and over JDBC, with counts taken during the write."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from alambique.operators.joins import anti_join_unknown

log = logging.getLogger(__name__)

BACKOFF_SECONDS = 20


@dataclass(frozen=True)
class ExportStats:
    """Outcome of one export."""

    destino: str
    exito: bool
    filas: int = 0
    modo: str | None = None
    archivos: int | None = None
    compresion: str | None = None
    intentos: int = 1
    error: str | None = None
    segundos: float = 0.0


_STATS_DDL = (
    "destino string, exito boolean, filas long, modo string, archivos int, "
    "compresion string, intentos int, error string, segundos double"
)


def export_stats(spark: SparkSession, stats: Iterable[ExportStats]) -> DataFrame:
    """One row per export."""
    return spark.createDataFrame([asdict(s) for s in stats], _STATS_DDL)


def _counted_write(
    df: DataFrame | None, target: str, write: Callable[[DataFrame], None], **facts
) -> ExportStats:
    """Run a write once; its rows are counted as they pass, not by a second job."""
    started = time.monotonic()

    def outcome(success: bool, **more) -> ExportStats:
        seconds = round(time.monotonic() - started, 3)
        return ExportStats(target, success, segundos=seconds, **{**facts, **more})

    if df is None or df.isEmpty():
        return outcome(False, error="no rows to export")
    rows = Observation()
    try:
        write(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    except Exception as error:
        log.error("export to %s failed: %s", target, error)
        return outcome(False, error=str(error))
    return outcome(True, filas=rows.get.get("rows", 0))


# -- Files --------------------------------------------------------------------


def export_to_csv(
    df: DataFrame | None,
    output_path: str,
    header: bool = True,
    delimiter: str = ",",
    mode: str = "overwrite",
    num_files: int | None = None,
    compression: str | None = None,
) -> ExportStats:
    """Write CSV files, as many as there are tasks unless a number is given.

    A fixed number is a shuffle into that many tasks: one file means one task
    writes the whole table, so it is never the default.
    """
    options = {"header": header, "sep": delimiter, "encoding": "UTF-8"}
    if compression:
        options["compression"] = compression

    def write(rows: DataFrame) -> None:
        placed = rows.repartition(num_files) if num_files else rows
        placed.write.options(**options).mode(mode).csv(output_path)

    return _counted_write(
        df, output_path, write, modo=mode, archivos=num_files, compresion=compression
    )


def export_to_parquet(
    df: DataFrame | None,
    output_path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> ExportStats:
    """Write parquet, one folder per value of the partition columns.

    Rebalancing sends each value to few tasks, which keeps files large, and
    splits a value that is too big for one.
    """

    def write(rows: DataFrame) -> None:
        if partition_by:
            rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
        rows.write.partitionBy(*partition_by).mode(mode).parquet(output_path)

    return _counted_write(df, output_path, write, modo=mode)


def export_multiple_tables_to_csv(
    tables: Mapping[str, DataFrame], base_path: str, **options
) -> dict[str, ExportStats]:
    """One folder per table under ``base_path``."""
    return {
        name: export_to_csv(df, f"{base_path.rstrip('/')}/{name}", **options)
        for name, df in tables.items()
    }


# -- JDBC ---------------------------------------------------------------------


@dataclass(frozen=True)
class JdbcConnection:
    url: str | None = None
    user: str | None = None
    password: str | None = None
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"

    def is_complete(self) -> bool:
        return bool(self.url and self.user and self.password)

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


def jdbc_write_options(
    connection: JdbcConnection,
    table: str,
    batchsize: int,
    max_partitions: int,
    isolation: str = "READ_COMMITTED",
) -> dict[str, str]:
    return {
        **connection.options(table),
        "batchsize": str(batchsize),
        "isolationLevel": isolation,
        "numPartitions": str(max_partitions),
        "queryTimeout": "0",
    }


def _save(df: DataFrame, options: Mapping[str, str], mode: str) -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()


def _read(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def export_to_sql(
    df: DataFrame | None,
    table_name: str,
    connection: JdbcConnection,
    mode: str = "append",
    batchsize: int = 10_000,
    max_partitions: int = 8,
    retries: int = 3,
    key_columns: Sequence[str] | None = None,
    isolation: str = "READ_COMMITTED",
    save: Callable = _save,
    read: Callable = _read,
    wait: Callable[[float], None] = time.sleep,
) -> ExportStats:
    """Write a table over JDBC through a bounded number of connections.

    A failed write may have committed some of its partitions. Overwriting
    starts again; appending is tried again only with ``key_columns`` that are
    unique, and then without the rows that already arrived. Without them an
    append gets one attempt, because a second one could double rows.
    """
    if not connection.is_complete():
        return ExportStats(table_name, False, error="url, user and password required")
    options = jdbc_write_options(
        connection, table_name, batchsize, max_partitions, isolation
    )
    attempts = retries if mode == "overwrite" or key_columns else 1
    attempt = 0

    def write(rows: DataFrame) -> None:
        nonlocal attempt
        pending = rows
        while True:
            attempt += 1
            try:
                return save(pending.repartition(max_partitions), options, mode)
            except Exception as error:
                log.warning("attempt %s/%s failed: %s", attempt, attempts, error)
                if attempt >= attempts:
                    raise
            wait(BACKOFF_SECONDS * attempt)
            if mode != "overwrite":
                arrived = read(rows.sparkSession, connection.options(table_name))
                pending = anti_join_unknown(rows, arrived, key_columns)

    stats = _counted_write(df, table_name, write, modo=mode)
    return ExportStats(**{**asdict(stats), "intentos": max(attempt, 1)})


def export_multiple_tables_to_sql(
    tables: Mapping[str, DataFrame],
    connection: JdbcConnection,
    table_prefix: str = "",
    mode: str = "append",
    **options,
) -> dict[str, ExportStats]:
    return {
        name: export_to_sql(df, f"{table_prefix}{name}", connection, mode, **options)
        for name, df in tables.items()
    }
