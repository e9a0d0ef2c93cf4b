"""Staged loads that appear in their target at once.

One published version holds a load's new rows, the rows it leaves over, and the
names of the staged files it has taken in. So whenever a load ends, readers see
the target and the staging folder both before it or both after it; deleting the
files is only tidying up. A load that died left nothing that a reader sees, and
the next one loads its files again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.operators.dedup import keep_one
from alambique.operators.load import KEEP_ALL, KEEP_FIRST, has_key, new_rows
from alambique.plans.cleaning import conform
from alambique.plans.loading import MONTH, PRUNE_BY, load_key, month_of, staged_months
from alambique.schemas import FACT, target_schema
from alambique.sinks.versions import Conflict, Part, Version, VersionedTable
from alambique.storage import UNMEASURED, Measured, materialize_measured

ROWS, REST = "filas", "restos"


def _schema(table: str) -> T.StructType:
    schema = target_schema(table)
    if table not in PRUNE_BY:
        return schema
    return T.StructType([*schema, T.StructField(MONTH, T.StringType())])


def _with_month(rows: DataFrame, table: str) -> DataFrame:
    if table not in PRUNE_BY:
        return rows
    return rows.select("*", month_of(PRUNE_BY[table]))


class VersionedTarget:
    """A target table that staged files are loaded into version by version."""

    def __init__(self, spark: SparkSession, root: str, table: str = FACT) -> None:
        self.spark, self.table = spark, table
        self.store = VersionedTable(spark, root, [MONTH] if table in PRUNE_BY else [])

    def read(self, version: Version | None = None, months: list[str] | None = None) -> DataFrame:
        """The target's rows in a version, the latest unless one is given."""
        found = self.store.read(version or self.store.latest(), ROWS, _schema(self.table))
        if months is not None and self.table in PRUNE_BY:
            found = found.filter(F.col(MONTH).isin(months))
        return found.select(*target_schema(self.table).names)

    def remainder(self, staging_path: str, version: Version | None = None) -> DataFrame:
        """What is left in staging: files not taken in, and rows without a key."""
        version = version or self.store.latest()
        rest = self.store.read(version, REST, _schema(self.table))
        rest = rest.select(*target_schema(self.table).names)
        files = self.store.waiting(staging_path, version)
        return rest.unionByName(self._staged(files)) if files else rest

    def _staged(self, files: list[str]) -> DataFrame:
        schema = target_schema(self.table)
        return self.spark.read.schema(schema).parquet(*files)

    def load(
        self, staging_path: str, policy: str = KEEP_ALL, most_files: int = 10_000
    ) -> DataFrame | None:
        """Load staged files, at most so many; returns the counts, None without any.

        Raises ``Conflict`` if another load was published meanwhile; nothing of
        this one is seen then, and it can be made again.
        """
        before = self.store.latest()
        before_taken = self.store.delete_taken(before)
        files = self.store.waiting(staging_path, before)[:most_files]
        if not files:
            return None
        try:
            written, counts = self._insert(files, before, policy)
        except Exception as error:
            # A load that has taken the same files in deletes them, even while they are read.
            if self.store.latest().number != before.number:
                raise Conflict(f"another load was published after {before.number}") from error
            raise
        parts = (*before.parts, *written)
        after = self.store.publish(before, parts=parts, taken=(*before_taken, *files), note=policy)
        self.store.delete_taken(after)
        return counts

    def _insert(
        self, files: list[str], before: Version, policy: str
    ) -> tuple[list[Part], DataFrame]:
        """Write the new rows and those without a key; returns their folders and counts.

        Staged files do not change, so they are read as they are, and rows go from the
        join to their folder. Written files know their number of rows.
        """
        keys, rows = load_key(self.table), self._staged(files)
        staged = Measured(rows, rows.count(), UNMEASURED)
        if before.of(ROWS):
            target = self.read(before, staged_months(rows, self.table))
            new = new_rows(staged, target, keys, KEEP_ALL, PRUNE_BY.get(self.table))
        else:
            new = rows.filter(has_key(keys))
        found = None
        if policy == KEEP_FIRST:
            stored = materialize_measured(new, f"new-{self.table}")
            found, new = stored.rows, keep_one(stored.df, keys)
        written, inserted = self._write(conform(new, self.table), ROWS)
        rest, keyless = self._write(rows.filter(~has_key(keys)), REST)
        found = inserted if found is None else found
        counts = {
            "Registros_Procesados": staged.rows,
            "Registros_Insertados": inserted,
            "Registros_Existentes": staged.rows - found - keyless,
            "Registros_Duplicados": found - inserted,
            "Registros_Errores": keyless,
        }
        schema = ", ".join(f"{name} long" for name in counts)
        return written + rest, self.spark.createDataFrame([tuple(counts.values())], schema)

    def _write(self, rows: DataFrame, kind: str) -> tuple[list[Part], int]:
        """The folder that rows are written to, none without any, and their number."""
        part = self.store.write(_with_month(rows, self.table), kind)
        n = self.store.count(part)
        if not n:
            self.store.remove(part)
        return [part] if n else [], n

    def tidy(self) -> None:
        """Merge small folders and delete what no kept version needs."""
        for kind in (ROWS, REST):
            self.store.compact(kind, _schema(self.table))
        self.store.vacuum()

    def drain(self, staging_path: str, policy: str = KEEP_ALL, files_per_batch: int = 1000) -> int:
        """Load all staged files, so many at a time; returns the number of loads.

        What a batch costs depends on its own files: the target's files of other
        months are not opened, the record of a version names a number of folders
        that grows with the logarithm of the loads, and files taken in are gone.
        With ``keep_first`` a key of several batches comes from the first of them.
        """
        loads = 0
        while True:
            try:
                counts = self.load(staging_path, policy, files_per_batch)
                if counts is None:
                    return loads
                loads += 1
                self.tidy()
            except Conflict:
                continue  # another writer was first; start from its version
