"""Side-by-side run of the registered queries and their SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with one view per supplied table."""
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    """Column names in order, and the rows, sorted."""
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    return _sorted(names, result.fetchall())


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    """The same for a Spark result."""
    return _sorted(frame.columns, [tuple(row) for row in frame.collect()])


def _sorted(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(
        picked, key=lambda row: [(value is None, str(value)) for value in row]
    )
