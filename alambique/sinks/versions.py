"""Tables whose loads appear at once or not at all.

A load writes a folder of its own, which no reader looks at, and then publishes a
version: a small record of the folders that the table consists of. The record's
name is its number, so of two writers that start from one version only one gets
the next. Readers are pinned to the version they were given. Folders of equal
rank are merged once there are FANOUT of them, so a record stays short however
many loads there were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError

from alambique.storage import delete

#: Folders of one rank that are merged, and versions that readers may be pinned to.
FANOUT, KEPT = 16, 8

_PART = "parte"


class Conflict(RuntimeError):
    """Another writer has published the version that was to be the next."""


@dataclass(frozen=True)
class Part:
    """A folder of rows; its rank tells how often it was merged. ``kind`` keeps
    apart the rows of one table from others published with them."""

    name: str
    kind: str
    rank: int = 0


@dataclass(frozen=True)
class Version:
    """What a table consists of, and the source files it has taken in that are still
    to be deleted."""

    number: int = 0
    parts: tuple[Part, ...] = ()
    taken: tuple[str, ...] = ()
    note: str = ""

    def of(self, kind: str) -> list[Part]:
        return [p for p in self.parts if p.kind == kind]


class VersionedTable:
    """A folder with versions; ``partition_by`` names columns that have folders in
    each part."""

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_by = list(partition_by)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- Records --------------------------------------------------------------

    def _path(self, *names: str):
        return self._hadoop.Path("/".join([self.root, *names]))

    def numbers(self) -> list[int]:
        """Numbers of the versions there are, ascending."""
        folder = self._path("versiones")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def latest(self) -> Version:
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def version(self, number: int) -> Version:
        stream = self._files.open(self._path("versiones", f"{number:012d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        parts = tuple(Part(**p) for p in found.pop("parts"))
        return Version(parts=parts, taken=tuple(found.pop("taken")), **found)

    def publish(self, before: Version, **changes) -> Version:
        """Make the successor of ``before`` the table's version, if it has none yet.

        The record is written aside and then given its name by a rename that
        refuses a name in use, which the file system does at once.
        """
        after = replace(before, number=before.number + 1, **changes)
        aside = self._path("versiones", f"_{uuid.uuid4().hex}")
        out = self._files.create(aside, False)
        out.write(json.dumps(asdict(after)).encode())
        out.close()
        context = self._hadoop.FileContext.getFileContext(
            self._files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        refuse = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 1)
        refuse[0] = self._hadoop.Options.Rename.NONE
        try:
            context.rename(aside, self._path("versiones", f"{after.number:012d}"), refuse)
        except Py4JJavaError as error:
            self._files.delete(aside, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(f"version {after.number} of {self.root} exists") from None
            raise
        return after

    # -- Rows -----------------------------------------------------------------

    def write(self, rows: DataFrame, kind: str, rank: int = 0) -> Part:
        """Write rows to a folder that belongs to no version yet."""
        part = Part(uuid.uuid4().hex, kind, rank)
        if self.partition_by:
            rows = rows.hint("rebalance", *[F.col(c) for c in self.partition_by])
        rows.write.partitionBy(*self.partition_by).parquet(self._folder(part))
        return part

    def count(self, part: Part) -> int:
        """Rows of a folder, as its files state them."""
        return self.spark.read.schema(T.StructType()).parquet(self._folder(part)).count()

    def remove(self, part: Part) -> None:
        """Delete a folder that belongs to no version."""
        delete(self.spark, self._folder(part))

    def _folder(self, part: Part) -> str:
        return f"{self.root}/partes/{_PART}={part.name}"

    def read(self, version: Version, kind: str, schema: T.StructType) -> DataFrame:
        """The rows of one kind in this version; ``schema`` includes the columns
        that have folders."""
        return self._rows(version.of(kind), schema)

    def _rows(self, parts: Sequence[Part], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema, T.StructField(_PART, T.StringType())])
        reader = self.spark.read.schema(stored).option("basePath", f"{self.root}/partes")
        return reader.parquet(*map(self._folder, parts)).select(*schema.names)

    # -- Upkeep ---------------------------------------------------------------

    def compact(
        self, kind: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame] = lambda x: x
    ) -> Version:
        """Merge the folders of the lowest rank that has FANOUT of them.

        ``merge`` may combine rows that stand for the same thing. What is written
        anew grows with the logarithm of the number of loads for each row.
        """
        version = self.latest()
        for rank in sorted({p.rank for p in version.of(kind)}):
            old = [p for p in version.of(kind) if p.rank == rank]
            if len(old) >= FANOUT:
                new = self.write(merge(self._rows(old, schema)), kind, rank + 1)
                left = tuple(p for p in version.parts if p not in old)
                return self.publish(version, parts=(*left, new), note="compactar")
        return version

    def vacuum(self) -> None:
        """Delete records older than KEPT versions, and the folders that only those
        name. Folders that no record has named yet are a load's own: they stay."""
        numbers = self.numbers()
        if len(numbers) <= KEPT:
            return
        held = {p for n in numbers[-KEPT:] for p in self.version(n).parts}
        for number in numbers[:-KEPT]:
            for part in self.version(number).parts:
                if part not in held:
                    delete(self.spark, self._folder(part))
            self._files.delete(self._path("versiones", f"{number:012d}"), False)

    def remove_orphans(self, older_than_ms: int) -> int:
        """Delete folders that no version names and that were last changed that long
        ago, as loads that died leave them; returns their number."""
        folder = self._path("partes")
        if not self._files.exists(folder):
            return 0
        held = {f"{_PART}={p.name}" for n in self.numbers() for p in self.version(n).parts}
        limit = self.spark._jvm.System.currentTimeMillis() - older_than_ms
        old = [
            s.getPath()
            for s in self._files.listStatus(folder)
            if s.getPath().getName() not in held and s.getModificationTime() <= limit
        ]
        for path in old:
            self._files.delete(path, True)
        return len(old)

    # -- Source files ---------------------------------------------------------

    def waiting(self, source: str, version: Version) -> list[str]:
        """Files in a folder that the table has not taken in, the oldest first."""
        path = self._hadoop.Path(source)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        taken, found = set(version.taken), []
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                full = status.getPath().toString()
                if full not in taken:
                    found.append((status.getModificationTime(), full))
        return [full for _, full in sorted(found)]

    def delete_taken(self, version: Version) -> tuple[str, ...]:
        """Delete the files taken in; returns those that could not be deleted."""
        left = []
        for name in version.taken:
            path = self._hadoop.Path(name)
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if not files.delete(path, False) and files.exists(path):
                left.append(name)
        return tuple(left)
