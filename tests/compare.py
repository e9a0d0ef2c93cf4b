"""Compare a registered query with its oracle SQL, order-insensitively."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


#: Type of a Spark column and the one DuckDB must return for it.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, run, sql: str, sf_dir: str) -> str:
    """Empty when both agree, else what differs."""
    df = run(spark, sf_dir)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = {d[0]: str(d[1]) for d in result.description}
    wrong = [(c, t, theirs[c]) for c, t in df.dtypes if TYPES.get(t) != theirs[c]]
    if wrong:
        return f"types {wrong}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(columns, result.fetchall())
    if ours == theirs:
        return "" if ours else "no rows"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} against {sum(theirs.values())} rows, "
        f"{sum(extra.values())} only in Spark, e.g. {sorted(map(str, extra))[:2]}, "
        f"{sum(missing.values())} only in DuckDB, e.g. {sorted(map(str, missing))[:2]}"
    )
