"""Spark result against DuckDB's for the same tables, as unordered bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def tables_of(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows_of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def rows_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    given = [column[0] for column in result.description]
    names = sorted(given)
    places = [given.index(name) for name in names]
    return names, Counter(tuple(row[i] for i in places) for row in result.fetchall())


def kinds_of_spark(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


# DuckDB's type names in Spark's words.
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def kinds_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: KINDS.get(row[1], row[1]) for row in described}


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
