"""Row functions over Arrow batches, a bounded number of rows at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows turned into Python objects at once; texts may be very long.
ROWS = 256


def map_rows(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[..., Iterable[tuple]]],
) -> DataFrame:
    """Apply a function to each row; each task makes its function once.

    The function takes the row's columns in order and gives any number of rows
    of ``schema``. Integers stay exact and NULL stays None.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_function = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                columns = batch.slice(at, ROWS).to_pydict().values()
                rows = [out for row in zip(*columns) for out in row_function(*row)]
                yield to_batch(rows, arrow)

    return df.mapInArrow(run, schema)


def to_batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def trimmed(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function; when a task's rows end, the worker, which waits for the next
    task, gives the memory it needed back to the system."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return whole


@contextmanager
def batches_of(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Jobs run within hand at most so many rows or bytes to Python at once."""
    limits = {"Records": rows, "Bytes": size}
    names = {f"spark.sql.execution.arrow.max{k}PerBatch": v for k, v in limits.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
