"""Reading the star schema from delimited files."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alambique.schemas import TABLES, source_schema

log = logging.getLogger(__name__)

PREFIX = "datos_bi_sucio_bebidas"
CORRUPT = "registro_corrupto"


def load_table(
    spark: SparkSession,
    table_name: str,
    filepath: str,
    delimiter: str = ",",
    encoding: str = "utf-8",
    keep_corrupt: bool = False,
    header: bool = True,
) -> DataFrame | None:
    """One table by its fixed schema, or None where the path does not exist.

    Text is trimmed and a field that does not fit its type becomes NULL.
    ``keep_corrupt`` adds the raw line of such rows, for ``split_corrupt``.
    """
    schema = source_schema(table_name)
    if keep_corrupt:
        schema = schema.add(CORRUPT, "string")
    reader = spark.read.schema(schema).options(
        header=header,
        sep=delimiter,
        encoding=encoding,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )
    if keep_corrupt:
        # A pruned read would judge a line by the chosen columns only.
        reader = reader.option("columnPruning", False)
    try:
        return reader.csv(filepath)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s: no file at %s", table_name, filepath)
        return None


def load_all_tables(
    spark: SparkSession, base_path: str = ".", filename_prefix: str = PREFIX, **options
) -> dict[str, DataFrame]:
    """Every table found as ``{prefix}_{table}.csv``; a missing one is skipped."""
    base = base_path.rstrip("/")
    found = {
        name: load_table(spark, name, f"{base}/{filename_prefix}_{name}.csv", **options)
        for name in TABLES
    }
    return {name: df for name, df in found.items() if df is not None}


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows read in full, and the quarantined rest with their raw lines.

    A line with too few or too many fields, or with a field that does not fit
    its type, is corrupt whichever columns a query goes on to use.
    """
    # Always true, which the optimizer cannot know: only the fields of columns
    # the scan is asked for are checked, so it has to be asked for all of them.
    complete = F.hash(*df.columns) >= -(1 << 31)
    corrupt = F.col(CORRUPT).isNotNull()
    good, bad = df.filter(complete & ~corrupt), df.filter(complete & corrupt)
    return good.drop(CORRUPT), bad


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabla, registros) per loaded table, in order of the names."""
    counts = [
        tables[name].agg(F.lit(name).alias("tabla"), F.count("*").alias("registros"))
        for name in sorted(tables)
    ]
    whole = counts[0]
    for count in counts[1:]:
        whole = whole.unionByName(count)
    return whole
