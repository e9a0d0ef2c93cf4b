"""Tables written to the folder all executors share.

A result that is read more than once is written here and read back, which cuts
its lineage and survives the loss of any executor.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse.

    Executors share both. A warehouse that is a plain folder, as by default, is one
    of the driver's machine: it is used in local mode alone.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
        local = re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or "")
        if local or re.match(r"(?!file:)[a-z][a-z0-9+.-]*:", warehouse):
            root = warehouse
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The one folder that all tables of this application are written to."""
    return f"{scratch_root(spark)}/alambique/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the run's folder that no other call returns."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> bool:
    """Delete the run's folder; frames that read from it can no longer be used."""
    return delete(spark, run_folder(spark))


def delete(spark: SparkSession, name: str) -> bool:
    """Delete a file or folder of any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back with file statistics."""
    return materialize_measured(df, label).df


#: Bytes a row is taken to have where its columns are nested.
UNMEASURED = 1 << 40


@dataclass(frozen=True)
class Measured:
    """A written table with its number of rows and its in-memory bytes."""

    df: DataFrame
    rows: int
    size: int


def materialize_measured(df: DataFrame, label: str) -> Measured:
    """Write ``df`` once, counting its rows and text as they pass."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    df.observe(seen, rows, _text_bytes(df).alias("text")).write.parquet(path)
    n = seen.get.get("rows") or 0
    size = n * _fixed_bytes(df) + (seen.get.get("text") or 0)
    return Measured(spark.read.schema(df.schema).parquet(path), n, size)


def run_together(jobs: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Results of independent jobs, submitted at the same time."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


def materialize_all(frames: Mapping[str, DataFrame]) -> dict[str, Measured]:
    """Write several independent tables at the same time."""
    return run_together(
        {n: lambda n=n, df=df: materialize_measured(df, n) for n, df in frames.items()}
    )


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.BinaryType))


def _text_bytes(df: DataFrame) -> Column:
    text = [f"`{f.name}`" for f in df.schema if _is_text(f)]
    lengths = (F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in text)
    return F.sum(sum(lengths, F.lit(0)).cast("long"))


def _fixed_bytes(df: DataFrame) -> int:
    """Row header, and a word per column or two for text and decimals.

    Nested columns have no bound, so a table with any counts as too large to
    broadcast unless its caller knows better.
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    if any(isinstance(f.dataType, nested) for f in df.schema):
        return UNMEASURED
    wide = (T.StringType, T.BinaryType, T.DecimalType)
    return 16 + sum(16 if isinstance(f.dataType, wide) else 8 for f in df.schema)
