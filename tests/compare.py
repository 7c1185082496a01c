"""Exact, order-insensitive comparison of results."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# DuckDB's names for the Spark types that results use.
DUCKDB_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def spark_result(df: DataFrame) -> tuple[dict[str, str], Counter]:
    names = sorted(df.columns)
    types = {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in df.schema}
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return types, Counter(tuple(r) for r in rows)


def duckdb_result(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], Counter]:
    result = con.sql(sql)
    types = dict(zip(result.columns, map(str, result.types)))
    names = sorted(result.columns)
    rows = result.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    return types, Counter(rows)
