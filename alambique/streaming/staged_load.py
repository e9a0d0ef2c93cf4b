"""Drain staged files into the target.

The staging folder is the stream: each micro-batch keeps the rows of some new
files under its own number, so a batch that is replayed replaces itself. What
was kept is then loaded at once and compared with the target as it was before,
so the number of files in a batch changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alambique.operators.load import KEEP_ALL
from alambique.plans.loading import load_table_into
from alambique.schemas import FACT, target_schema
from alambique.sinks.versions import Version, VersionedTable

BATCH = "lote"


def drain_staging(
    spark: SparkSession,
    staging_path: str,
    target_path: str,
    checkpoint_path: str,
    table: str = FACT,
    files_per_batch: int = 1000,
    policy: str = KEEP_ALL,
) -> DataFrame | None:
    """Load all files now in staging; returns the counts, None if none is new.

    New files wait for the next call. A call that failed while loading is made
    good by the next one: the last batch loaded is recorded after the insert, and
    rows that already arrived are in the target by then. Rows of loaded batches are
    deleted, so a call reads and keeps what is new, however many came before.
    """
    kept, ledger = f"{checkpoint_path}/rows", VersionedTable(spark, f"{checkpoint_path}/loaded")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{kept}/{BATCH}={number}")

    staged = (
        spark.readStream.schema(target_schema(table))
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(staging_path)
    )
    query = (
        staged.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{checkpoint_path}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    done = ledger.latest()
    _forget(spark, kept, done)
    rows = _read(spark, kept)
    last = None if rows is None else rows.agg(F.max(BATCH)).first()[0]
    if last is None:
        return None
    columns = target_schema(table).names
    _, counts = load_table_into(rows.select(*columns), table, target_path, policy)
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    _forget(spark, kept, ledger.publish(done, note=str(last)))
    ledger.vacuum()
    return counts


def _forget(spark: SparkSession, kept: str, done: Version) -> None:
    """Delete the rows of batches that are loaded."""
    path = spark._jvm.org.apache.hadoop.fs.Path(kept)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not done.note or not files.exists(path):
        return
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) <= int(done.note):
            files.delete(status.getPath(), True)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # The folder is there without a batch once all of them are loaded.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
