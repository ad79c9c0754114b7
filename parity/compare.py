"""Run a registered query and its SQL twin on the same tables and compare rows."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

Rows = list[tuple]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-memory database with every table of ``sf_dir`` as a view."""
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return db


def spark_rows(df: DataFrame) -> tuple[list[str], Rows]:
    names = sorted(df.columns)
    return names, _sorted(tuple(r) for r in df.select(*names).collect())


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Rows]:
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    picks = [columns.index(n) for n in names]
    return names, _sorted(tuple(row[p] for p in picks) for row in cursor.fetchall())


def difference(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs first between the two results, or None."""
    names, ours = spark_rows(df)
    other_names, theirs = sql_rows(db, sql)
    if names != other_names:
        return f"columns differ: {sorted(set(names) ^ set(other_names))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        for name, x, y in zip(names, a, b, strict=True):
            if x != y or type(x) is not type(y):
                return f"{name}: {x!r} against {y!r}\n  {a}\n  {b}"
    return None


def _sorted(rows) -> Rows:
    return sorted(rows, key=lambda row: tuple((v is None, _sortable(v)) for v in row))


def _sortable(value):
    if value is None:
        return ""
    if isinstance(value, dt.datetime | dt.date):
        return value.isoformat()
    return value
